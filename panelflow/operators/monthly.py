"""Monthly aggregation and summary of article features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelflow.functions.calendar import year_month
from panelflow.functions.numbers import exact_mean, one_row
from panelflow.operators.tfidf import keyword_columns

ROUNDED_SCORES = ["sentiment_score", "vocabulary_richness"]


def parse_published(df: DataFrame, published: str = "published") -> DataFrame:
    """``published_at`` and ``year_month``; rows whose date does not parse are dropped."""
    return (
        df.withColumn("published_at", F.col(published).cast("string").try_cast("timestamp_ntz"))
        .filter(F.col("published_at").isNotNull())
        .withColumn("year_month", year_month("published_at"))
    )


def monthly_text_features(df: DataFrame) -> DataFrame:
    """One row per month: means of scores, sums of keyword counts, article count."""
    means = [exact_mean(c).alias(f"text_{c}") for c in ROUNDED_SCORES if c in df.columns]
    if "tfidf_mean" in df.columns:
        means.append(F.avg("tfidf_mean").alias("text_tfidf_mean"))
    sums = [F.sum(c).alias(f"text_{c}") for c in keyword_columns(df)]
    return df.groupBy("year_month").agg(*means, *sums, F.count(F.lit(1)).alias("text_article_count"))


def text_summary(articles: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row of corpus totals; keyword totals are a ``(keyword, total)`` array."""
    keywords = keyword_columns(articles)
    months = one_row(
        monthly,
        F.count(F.lit(1)).alias("months"),
        F.avg("text_article_count").alias("per_month"),
    )
    totals = F.array(
        *[
            F.struct(F.lit(k).alias("keyword"), F.coalesce(F.sum(k), F.lit(0)).alias("total"))
            for k in keywords
        ]
    )
    return articles.agg(
        F.count(F.lit(1)).alias("articles"),
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"),
        F.avg("token_count").alias("avg_tokens"),
        exact_mean("sentiment_score").alias("avg_sentiment"),
        totals.alias("keyword_totals"),
    ).select(
        "*", months["months"].alias("months"), months["per_month"].alias("avg_articles_per_month")
    )


def keyword_totals(articles: DataFrame) -> DataFrame:
    """``(keyword, total)`` rows over all articles."""
    return articles.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in keyword_columns(articles)]).unpivot(
        [], keyword_columns(articles), "keyword", "total"
    )
