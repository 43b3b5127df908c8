"""Evaluate costly columns a single time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose expressions a later filter does not evaluate again.

    A filter on a projected column is pushed below the projection together with a copy of
    the expression.  Columns out of a one-row generator are not copied.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))
