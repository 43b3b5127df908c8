"""Boilerplate lines by their share of a site's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelflow.session import BROADCAST_ROW_LIMIT, materialize, rows_up_to

SALTS = 64


def _keys(text: Column) -> Column:
    """A digest per line without outer blanks; null for a blank line, which is never counted."""
    return F.transform(
        F.split(text, "\n"),
        lambda line: F.when(F.trim(F.translate(line, "\t\r", "  ")) != "", F.md5(F.trim(F.translate(line, "\t\r", "  ")))),
    )


def boilerplate_lines(
    df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.05, min_pages: int = 5
) -> DataFrame:
    """``(host, line, pages, total)``: lines on more than ``max_ratio`` of a host's pages.

    ``line`` is the MD5 of the line.  Lines on fewer than ``min_pages`` pages never count, so
    that small sites are left alone.  Counts are combined in each task before the shuffle.
    """
    pages = df.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))
    lines = pages.select("host", F.explode(F.array_distinct(_keys(F.col("text")))).alias("line"))
    counts = lines.filter("line IS NOT NULL").groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total")).withColumnRenamed("host", "_host")
    often = counts.filter(F.col("pages") >= min_pages)
    joined = often.join(totals, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    return joined.filter(F.col("pages") > max_ratio * F.col("total"))


def drop_boilerplate(
    df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.05, min_pages: int = 5
) -> DataFrame:
    """``df`` without boilerplate lines, plus ``n_lines`` and ``n_dropped`` (replaced if present).

    A page counts a line once however often it has it.  Lines are compared without blanks at
    either end; what stays is unchanged and in order.  Blank lines are neither counted nor
    dropped.  A null text stays null with 0 lines; pages without host form a host of their own.
    Repeated rows count as pages of their own.  Other columns are carried along.
    """
    found = materialize(boilerplate_lines(df, host, text, max_ratio, min_pages))
    # A host has at most (lines per page) / max_ratio such lines.
    per_host = found.groupBy(F.col("host").alias("_host")).agg(F.collect_set("line").alias("_drop"))
    rows = df.withColumn("_row_host", F.col(f"`{host}`"))
    match = F.col("_row_host").eqNullSafe(F.col("_host"))
    if rows_up_to(found) is not None:  # at most BROADCAST_ROW_LIMIT digests
        joined = rows.join(F.broadcast(per_host), match, "left")
    else:
        spread = per_host.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (
            rows.withColumn("_salt", F.pmod(F.xxhash64(f"`{text}`"), F.lit(SALTS)).cast("int"))
            .join(spread, match & (F.col("_salt") == F.col("_part")), "left")
            .drop("_salt", "_part")
        )
    body = F.col(f"`{text}`")
    lines = F.arrays_zip(F.split(body, "\n").alias("line"), _keys(body).alias("key"))
    stays = F.filter(
        lines, lambda x: x["key"].isNull() | F.col("_drop").isNull() | ~F.array_contains(F.col("_drop"), x["key"])
    )
    n_lines = F.when(body.isNull(), F.lit(0)).otherwise(F.size(F.split(body, "\n"))).cast("long")
    return (
        joined.withColumn("_stays", F.transform(stays, lambda x: x["line"]))
        .withColumns({"n_lines": n_lines})
        .withColumn("n_dropped", F.when(body.isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("_stays")).cast("long"))
        .withColumn(text, F.when(body.isNull(), body).otherwise(F.array_join("_stays", "\n")))
        .drop("_row_host", "_host", "_drop", "_stays")
    )
