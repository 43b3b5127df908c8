"""Null and rounding rules shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def nan_to_null(col: Column | str) -> Column:
    """Missing numbers are NULL inside the engine; NaN would poison avg and max."""
    return F.nanvl(col, F.lit(None).cast("double"))


def clean_nans(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in cols})


def half_even(col: Column, digits: int = 4) -> Column:
    return F.bround(col, digits)


def exact_mean(col: str, digits: int = 4) -> Column:
    """Mean of values rounded to ``digits``: the decimal sum does not depend on row order."""
    total = F.sum(F.col(col).cast(f"decimal(18,{digits})")).cast("double")
    return F.when(F.count(col) > 0, total / F.count(col))


def one_row(df: DataFrame, *aggregates: Column) -> Column:
    """Named aggregates over ``df`` as one struct, usable as a scalar subquery.

    Evaluated once per query and inlined like a literal: no join, nothing collected.
    """
    return df.agg(F.struct(*aggregates).alias("stats")).scalar()
