"""A small lookup table inside an expression: no join and no shuffle of the large side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _slot(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def lookup_table(df: DataFrame, key: str, value: str, buckets: int) -> Column:
    """``df`` with unique text keys as one array of small maps, addressed by key hash.

    A scalar subquery: evaluated once, then part of the plan like a literal.  The caller
    has checked the size of ``df``; about one entry per bucket keeps lookups short.  Use
    the column once, right where it is looked up, so that rows never carry it.
    """
    entries = df.groupBy(_slot(F.col(key), buckets).alias("b")).agg(
        F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))).alias("entries")
    )
    slots = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    dense = slots.join(entries, "b", "left").agg(
        F.sort_array(F.collect_list(F.struct("b", "entries"))).alias("slots")
    )
    return dense.select(F.transform("slots", lambda s: F.map_from_entries(s["entries"]))).scalar()


def looked_up(table: Column, key: Column, buckets: int) -> Column:
    """Value of ``key`` or NULL."""
    return F.get(table, _slot(key, buckets))[key]
