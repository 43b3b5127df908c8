"""Registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf: plain(fn(spark, sf))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Column types every engine prints alike: text dates, rounded doubles, bigints."""

    def column(field):
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, DoubleType):
            c = F.round(c, 6) + F.lit(0.0)
        elif isinstance(kind, IntegralType):
            c = c.cast("bigint")
        elif isinstance(kind, ArrayType):
            c = F.array_join(c, " ")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


_CASTS = {
    "s": "{c}",
    "d": "strftime({c}, '%Y-%m-%d')",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    "f": "round(CAST({c} AS DOUBLE), 6) + 0.0",
    "i": "CAST({c} AS BIGINT)",
    "a": "array_to_string({c}, ' ')",
}


def select(out: str, body: str, ctes: str = "") -> str:
    """SQL returning the columns named in ``out`` (``name:kind``) of ``body``."""
    columns = []
    for item in out.split():
        name, kind = item.split(":")
        columns.append(_CASTS[kind].format(c=name) + f" AS {name}")
    return f"{ctes} SELECT {', '.join(columns)} FROM ({body}) AS q"
