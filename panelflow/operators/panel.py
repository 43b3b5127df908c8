"""Panel assembly: series, merge, master panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflow import schemas

PANEL_COLUMNS = [
    "date",
    "country_code",
    "country_name",
    "inflation_rate",
    "gdp_growth",
    "interest_rate",
]


def indicator_series(records: DataFrame) -> DataFrame:
    """Typed observations without null dates or values.  Order is left to the sink."""
    return records.select(
        "indicator",
        "country_code",
        "country_name",
        F.col("date").cast("date").alias("date"),
        F.col("value").cast("double").alias("value"),
    ).filter("date IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)")


def series_column(series: DataFrame, indicator: str, column: str) -> DataFrame:
    """One indicator of a long series table under its panel column name."""
    return series.filter(F.col("indicator") == indicator).select(
        "date", "country_code", "country_name", F.col("value").alias(column)
    )


def merge_indicators(
    base: DataFrame,
    others: Mapping[str, DataFrame | None],
    on: Sequence[str] = ("country_code", "date"),
) -> DataFrame:
    """Left-join value columns to the base indicator, for all countries at once.

    ``others`` maps a value column to its table; ``None`` gives a null column.  Repeated
    keys on the right repeat the base row.  Joins share the key, so the base side keeps
    its partitioning from one join to the next.
    """
    merged = base
    for column, table in others.items():
        if table is None:
            merged = merged.withColumn(column, F.lit(None).cast("double"))
        else:
            merged = merged.join(table.select(*on, column), list(on), "left")
    return merged.select(*[c for c in PANEL_COLUMNS if c in merged.columns])


def master_panel(panels: Sequence[DataFrame], ordered: bool = True) -> DataFrame:
    """All panels under one another, ordered by country and date; a table that is written needs no global order."""
    if not panels:
        return SparkSession.active().createDataFrame([], schemas.PANEL)
    union = panels[0]
    for panel in panels[1:]:
        union = union.unionByName(panel, allowMissingColumns=True)
    return union.orderBy("country_code", "date") if ordered else union
