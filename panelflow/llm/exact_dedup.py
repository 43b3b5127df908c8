"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelflow.session import broadcast_if_small, materialize

# Characters of the normalised text that the second step hashes.
PREFIX_CHARS = 128
# Parts into which every group is dealt where its result cannot be broadcast.
SALTS = 64


def without_spaces(text: Column) -> Column:
    """The text without ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _attach(rows: DataFrame, groups: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Left join of unique ``groups``; dealt into parts unless they are few."""
    small = broadcast_if_small(groups)
    if small is not groups:
        return rows.join(small, keys, "left")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(SALTS)).cast("int"))
    spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [*keys, "_salt"], "left").drop("_salt")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with columns ``keep_id``, ``group_size`` and ``kept`` (replaced if present).

    Texts are equal if identical after deleting ``[\\x20\\x09-\\x0D]``.  Of equal texts the row
    with the most characters in the original text, then the smallest id, stays.  Rows are
    first grouped by length, those sharing a length by a hash of their first characters, and
    only for rows that still share both is the whole text hashed (SHA-256).

    A null text counts as empty.  A null id loses against every other; where only null ids
    are equal, the row stays with ``keep_id`` null.  Rows that repeat an id with the same text
    are counted each in ``group_size`` and flagged alike.  Other columns are carried along.
    """
    norm = without_spaces(F.col(f"`{text_col}`"))
    sizes = {"_n": F.length(norm), "_prefix": F.xxhash64(F.substring(norm, 1, PREFIX_CHARS))}
    slim = materialize(df.select(*[c.alias(k) for k, c in sizes.items()]))
    lengths = slim.groupBy("_n").count().filter("count > 1").select("_n")
    shared = slim.join(broadcast_if_small(lengths), "_n", "left_semi")
    pairs = shared.groupBy("_n", "_prefix").count().filter("count > 1").select("_n", "_prefix", F.lit(True).alias("_shared"))

    text_id = F.col(f"`{id_col}`")
    rows = _attach(df.withColumns(sizes), materialize(pairs), ["_n", "_prefix"], id_col)
    rows = rows.withColumn("_full", F.when(F.col("_shared"), F.sha2(norm, 256))).drop("_n", "_prefix", "_shared")
    longest = F.struct(
        (-F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).alias("n"),
        text_id.isNull().alias("missing"),
        text_id.alias("id"),
    )
    groups = (
        rows.filter("_full IS NOT NULL")
        .groupBy("_full")
        .agg(F.count(F.lit(1)).alias("_size"), F.min(longest).alias("_best"))
        .filter("_size > 1")
        .select("_full", "_size", F.col("_best.id").alias("_keep"))
    )
    out = _attach(rows, materialize(groups), ["_full"], id_col)
    alone = F.col("_size").isNull()
    keep = F.when(alone, text_id).otherwise(F.col("_keep"))
    return out.withColumns(
        {
            "keep_id": keep,
            "group_size": F.coalesce("_size", F.lit(1)).cast("long"),
            "kept": alone | text_id.eqNullSafe(F.col("_keep")),
        }
    ).drop("_full", "_size", "_keep")
