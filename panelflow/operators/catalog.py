"""Catalogue and descriptive reports over series and datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelflow.functions.numbers import nan_to_null, one_row


def series_report(series: DataFrame, countries: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Status and value range of every expected (country, indicator) pair."""
    expected = countries.select(
        "country_code", F.explode(F.array(*[F.lit(i) for i in indicators])).alias("indicator")
    )
    value = nan_to_null(F.col("value"))
    found = series.groupBy("country_code", "indicator").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
        F.avg(value).alias("value_mean"),
        F.count_if(value.isNull()).alias("null_count"),
    )
    report = expected.join(found, ["country_code", "indicator"], "left")
    status = F.when(F.col("records").isNull(), "failed_or_empty").otherwise("success")
    return report.withColumn("status", status).withColumn(
        "records", F.coalesce("records", F.lit(0))
    )


def upload_id(file_name: Column) -> Column:
    return F.concat(F.lit("upload_"), F.regexp_replace(file_name, r"\.[^.]*$", ""))


def dataset_catalog(panel: DataFrame, uploads: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Available datasets with their record counts; uploads without any date are skipped."""
    countries = panel.groupBy("country_code").agg(
        F.max("country_name").alias("name"), F.count(F.lit(1)).alias("records")
    )
    files = (
        uploads.groupBy(file_name)
        .agg(F.count(F.lit(1)).alias("records"), F.count("date").alias("dated"))
        .filter("dated > 0")
    )
    return countries.select(
        F.col("country_code").alias("id"), "name", F.lit("worldbank").alias("source"), "records"
    ).unionByName(
        files.select(
            upload_id(F.col(file_name)).alias("id"),
            F.col(file_name).alias("name"),
            F.lit("user_upload").alias("source"),
            "records",
        )
    )


def dataset_history(
    panel: DataFrame, uploads: DataFrame, dataset_id: str, file_name: str = "file_name"
) -> DataFrame:
    """Rows of one dataset, country codes first; dates as text.

    Both filters reach the scans (partition pruning on partitioned tables).
    """
    country = panel.filter(F.col("country_code") == dataset_id)
    hits = one_row(country.limit(1), F.count(F.lit(1)).alias("n"))["n"]
    upload = uploads.filter((upload_id(F.col(file_name)) == dataset_id) & (hits == 0)).drop(file_name)
    rows = country.unionByName(upload, allowMissingColumns=True)
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def dataset_profile(df: DataFrame, by: str = "dataset_id") -> DataFrame:
    """Source, size, columns and date range per dataset."""
    is_upload = F.startswith(F.col(by), F.lit("upload_"))
    columns = [c for c in df.columns if c not in (by, "name")]
    return (
        df.groupBy(by)
        .agg(
            F.max("name").alias("name"),
            F.count(F.lit(1)).alias("records"),
            F.min("date").alias("date_min"),
            F.max("date").alias("date_max"),
        )
        .withColumn("source", F.when(is_upload, "user_upload").otherwise("worldbank"))
        .withColumn("columns", F.array(*[F.lit(c) for c in columns]))
        .withColumn(
            "name",
            F.when(is_upload, F.concat(F.substring(F.col(by), F.lit(8), F.length(by)), F.lit(".csv"))).otherwise(
                F.col("name")
            ),
        )
    )


def series_stats(df: DataFrame, value: str = "inflation_rate", by: str = "dataset_id") -> DataFrame:
    """Mean, extremes and sample deviation per dataset."""
    v = nan_to_null(F.col(value))
    return df.groupBy(by).agg(
        F.avg(v).alias("mean"),
        F.max(v).alias("max"),
        F.min(v).alias("min"),
        F.stddev_samp(v).alias("std"),
    )


def history_chart_series(df: DataFrame, by: str = "dataset_id") -> DataFrame:
    """Chart columns in date order; fails where a base column is missing."""
    missing = [c for c in ("date", "inflation_rate") if c not in df.columns]
    if missing:
        raise ValueError(f"dataset lacks columns {missing}")
    optional = [c for c in ("gdp_growth",) if c in df.columns]
    return df.select(by, "date", "inflation_rate", *optional).orderBy(by, "date")
