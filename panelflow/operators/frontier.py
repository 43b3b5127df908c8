"""Crawl-frontier operators over feed entries and fetched pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflow import config
from panelflow.functions.numbers import one_row


def resolve_published(df: DataFrame, now: Column) -> DataFrame:
    """Publication time, else update time, else the crawl time."""
    return df.withColumn("published", F.coalesce("published", "updated", now))


def resolve_link(df: DataFrame) -> DataFrame:
    """``url`` from ``link``, else from the first alternate or HTML link; rows without are dropped."""
    usable = F.filter(
        "links",
        lambda l: F.coalesce(l["rel"] == "alternate", F.lit(False))
        | F.coalesce(F.startswith(l["type"], F.lit("text/html")), F.lit(False)),
    )
    url = F.coalesce(F.col("link"), F.get(usable, 0)["href"])
    return df.withColumn("url", url).filter(F.col("url") != "")


def feed_head(
    df: DataFrame,
    n: int = config.MAX_ENTRIES_PER_FEED,
    feed: str = "feed_name",
    rank: str = "entry_rank",
) -> DataFrame:
    """First ``n`` entries per feed.  Spark cuts each task to ``n`` rows per feed before the
    shuffle, so a feed holding most rows costs no more than a small one."""
    w = Window.partitionBy(feed).orderBy(rank)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def age_filter(
    df: DataFrame, now: Column, max_days: int = config.MAX_AGE_DAYS, published: str = "published"
) -> DataFrame:
    return df.filter(F.col(published) >= now - F.make_dt_interval(F.lit(max_days)))


def global_cap(
    df: DataFrame,
    n: int = config.MAX_ARTICLES,
    order: Sequence[str] = ("feed_rank", "entry_rank"),
    status: str = "status_code",
) -> DataFrame:
    """First ``n`` successful fetches in feed order (a top-n, no total sort)."""
    return df.filter(F.col(status) < 400).orderBy(*order).limit(n)


def page_identity(
    df: DataFrame, fetched: Column, url: str = "url", source: str = "source"
) -> DataFrame:
    """Host, hash and file name of a page; a missing source becomes ``fallback_<host>``."""
    url_hash = F.substring(F.md5(F.col(url)), 1, 12)
    host = F.replace(F.parse_url(F.col(url), F.lit("AUTHORITY")), F.lit("www."), F.lit(""))
    return (
        df.withColumn("host", host)
        .withColumn("url_hash", url_hash)
        .withColumn(source, F.coalesce(F.col(source), F.concat(F.lit("fallback_"), "host")))
        .withColumn(
            "file_name",
            F.concat(
                F.concat_ws("_", source, F.date_format(fetched, "yyyyMMdd"), "url_hash"),
                F.lit(".html"),
            ),
        )
    )


def page_size(df: DataFrame, html: str = "html") -> DataFrame:
    """UTF-8 size of the stored page."""
    return df.withColumn("html_size", F.octet_length(html).cast("bigint"))


def with_fallback(
    primary: DataFrame,
    fallback: DataFrame,
    order: Sequence[str],
    min_rows: int = config.MIN_PRIMARY_ROWS,
    cap: int = config.MAX_FALLBACK_ROWS,
) -> DataFrame:
    """Append up to ``cap`` fallback rows only where fewer than ``min_rows`` primary rows exist.

    The test reads at most ``min_rows`` primary rows and is part of the query.
    """
    found = one_row(primary.limit(min_rows), F.count(F.lit(1)).alias("n"))["n"]
    extra = fallback.orderBy(*order).limit(cap).filter(found < min_rows)
    return primary.unionByName(extra, allowMissingColumns=True)


def crawl_summary(df: DataFrame, is_fallback: str = "is_fallback") -> DataFrame:
    return df.agg(
        F.count_if(~F.col(is_fallback)).alias("total_articles"),
        F.count_if(F.col(is_fallback)).alias("total_fallback_pages"),
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum("html_size"), F.lit(0)).alias("total_bytes"),
    )


def articles_by_source(df: DataFrame, source: str = "source") -> DataFrame:
    return (
        df.groupBy(F.coalesce(F.col(source), F.lit("unknown")).alias("source"))
        .agg(F.count(F.lit(1)).alias("articles"))
        .orderBy("source")
    )
