"""Allow and block rules for URLs: expanded expressions joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelflow.session import broadcast_if_small

# Hex digits of the digest that are joined on; the whole digest confirms.
PREFIX_DIGITS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _digested(df: DataFrame, expression: Column) -> DataFrame:
    digest = F.sha2(expression, 256)
    return df.withColumn("_digest", digest).withColumn("_short", F.substring("_digest", 1, PREFIX_DIGITS))


def _rule_table(rules: DataFrame) -> DataFrame:
    """One row per distinct expression; block wins over allow."""
    whole = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin("allow", "block"))
    rule = F.concat(F.translate("host", UPPER, LOWER), "path")
    table = whole.groupBy(
        rule.alias("_rule"),
        _labels(F.col("host")).alias("_labels"),
        F.length("path").alias("_chars"),
    ).agg(F.max("verdict").alias("_verdict"))  # "block" > "allow"
    return _digested(table, F.col("_rule"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with columns ``host``, ``path``, ``rule`` and ``verdict`` (replaced if present).

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if the URL's path
    starts with the rule's; the longest expression (host and path together) wins, block
    before allow.  Without a fitting rule ``rule`` is null and ``verdict`` is ``default``.
    Each distinct URL is expanded into host suffixes and path prefixes of the sizes that
    occur in the rules, joined on the first digits of their digests; equal full digests and
    precedence decide.

    A null URL or one without ``://`` has empty host and path and fits no rule.  Repeated
    rows stay repeated.  Rules with a null field or an unknown verdict are ignored.  Other
    columns, whatever their names, are carried along.
    """
    table = _rule_table(rules)
    # Sizes, not rules, come to the driver: at most (labels in a host) x (path lengths).
    shapes = table.select("_labels", "_chars").distinct()
    rows = pages.withColumn("_url", F.col(f"`{url}`"))
    urls = rows.filter(F.col("_url").contains("://")).select("_url").distinct()
    parts = urls.select("_url", url_host(F.col("_url")).alias("_host"), url_path(F.col("_url")).alias("_path"))
    sizes = [(r["_labels"], r["_chars"]) for r in shapes.collect()]
    labels = F.split("_host", r"\.")
    expressions = [
        F.when(
            (F.size(labels) >= n) & (F.length("_path") >= chars),
            F.concat(F.substring_index("_host", ".", -n), F.substring("_path", 1, chars)),
        )
        for n, chars in sizes
    ]
    empty = F.array().cast("array<string>")
    expanded = parts.select("_url", F.explode(F.array(*expressions) if sizes else empty).alias("_part")).filter(
        F.col("_part").isNotNull()
    )
    expanded = _digested(expanded, F.col("_part")).withColumnRenamed("_digest", "_full")
    hits = expanded.join(broadcast_if_small(table), "_short").filter(F.col("_full") == F.col("_digest"))
    best = hits.groupBy("_url").agg(
        F.max(F.struct(F.length("_rule").alias("n"), F.col("_verdict").alias("v"), F.col("_rule").alias("r"))).alias("_best")
    )
    out = rows.join(broadcast_if_small(best), "_url", "left")
    return out.withColumns(
        {
            "host": url_host(F.col("_url")),
            "path": url_path(F.col("_url")),
            "rule": F.col("_best.r"),
            "verdict": F.coalesce(F.col("_best.v"), F.lit(default)),
        }
    ).drop("_url", "_best")
