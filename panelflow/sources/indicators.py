"""Landed indicator API pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_RECORDS = "array<struct<date:string,value:string>>"


def _records(payload: Column) -> Column:
    return F.from_json(F.get_json_object(payload, "$[1]"), _RECORDS)


def _well_formed(payload: Column) -> Column:
    """A page is a JSON list of at least two elements, the second a list or null."""
    records = F.get_json_object(payload, "$[1]")
    shaped = F.coalesce(records, F.lit("null")).rlike(r"^(\[|null$)")
    return F.coalesce((F.json_array_length(payload) >= 2) & shaped, F.lit(False))


def parse_indicator_payload(
    df: DataFrame,
    payload: str = "payload",
    country_code: str = "country_code",
    country_name: str = "country_name",
    indicator: str = "indicator",
) -> tuple[DataFrame, DataFrame]:
    """Explode landed pages into ``(records, rejects)``.

    Records without value or date are dropped; a page that is no list, a date that is no
    year and a value that is no number go to ``rejects`` with a reason.  The country
    comes from the request columns, not from the record.
    """
    page = F.col(payload)
    keys = [
        F.col(indicator).alias("indicator"),
        F.col(country_code).alias("country_code"),
        F.col(country_name).alias("country_name"),
    ]
    malformed = df.filter(~_well_formed(page)).select(
        *keys,
        F.lit("malformed payload").alias("reason"),
        page.alias("raw"),
    )
    records = (
        df.filter(_well_formed(page))
        .select(*keys, F.explode(_records(page)).alias("r"))
        .filter(F.col("r.date").isNotNull() & F.col("r.value").isNotNull())
        .withColumn("year", F.when(F.col("r.date").rlike(r"^\d{4}$"), F.col("r.date").cast("int")))
        .withColumn("number", F.col("r.value").try_cast("double"))
    )
    bad = F.col("year").isNull() | F.col("number").isNull()
    rejected = records.filter(bad).select(
        "indicator",
        "country_code",
        "country_name",
        F.when(F.col("year").isNull(), "date is not a year").otherwise("value is not a number").alias("reason"),
        F.to_json("r").alias("raw"),
    )
    good = records.filter(~bad).select(
        "indicator",
        "country_code",
        "country_name",
        F.make_date("year", F.lit(1), F.lit(1)).alias("date"),
        F.col("number").alias("value"),
    )
    return good, malformed.unionByName(rejected)


def page_completeness(
    df: DataFrame, payload: str = "payload", by: Sequence[str] = ("country_code", "indicator")
) -> DataFrame:
    """Pages landed against pages announced, per series.

    An empty page ends a series early, so such a series counts as complete.
    """
    page = F.col(payload)
    announced = F.coalesce(F.get_json_object(page, "$[0].pages").try_cast("int"), F.lit(1))
    number = F.coalesce(F.get_json_object(page, "$[0].page").try_cast("int"), F.lit(1))
    records = F.coalesce(F.json_array_length(F.get_json_object(page, "$[1]")), F.lit(0))
    return (
        df.filter(_well_formed(page))
        .select(*by, number.alias("n"), announced.alias("a"), records.alias("r"))
        .groupBy(*by)
        .agg(
            F.countDistinct("n").alias("pages_landed"),
            F.max("a").alias("pages_announced"),
            F.sum("r").alias("records"),
            F.max(F.col("r") == 0).alias("ended_early"),
        )
        .withColumn(
            "complete", F.col("ended_early") | (F.col("pages_landed") >= F.col("pages_announced"))
        )
    )
