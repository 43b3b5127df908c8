"""Monthly features per entity.

Windows run over one entity's months.  An entity has one row per calendar month, so a
window is bounded by the calendar however many entities or raw rows there are, and all
windows here share one partitioning and one order: one shuffle by entity serves them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from panelflow import config
from panelflow.functions.calendar import month_angle, months_before, year_month
from panelflow.functions.numbers import one_row


def _by_month(key: str, month: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(month)


def month_spine(
    df: DataFrame, key: str = "country_code", month: str = "date", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per entity and month between its first and last month.

    Each row is extended up to the month before the entity's next row, so no calendar
    table and no join is needed; added months hold nulls except for ``carry`` columns.
    """
    following = F.add_months(F.lead(month).over(_by_month(key, month)), -1)
    until = F.greatest(F.coalesce(following, F.col(month)), F.col(month))
    months = F.sequence(F.col(month), F.col("_until"), F.expr("INTERVAL 1 MONTH"))
    filled = df.withColumn("_until", until).select(
        *df.columns, F.explode(months).alias("_month")
    )

    def column(name: str) -> Column:
        if name == key or name in carry:
            return F.col(name)
        if name == month:
            return F.col("_month").alias(month)
        return F.when(F.col("_month") == F.col(month), F.col(name)).alias(name)

    return filled.select(*[column(c) for c in df.columns])


def add_lags(
    df: DataFrame,
    col: str = "inflation_rate",
    lags: Sequence[int] = (1, 3, 6, 12),
    key: str = "country_code",
    month: str = "date",
    prefix: str = "inflation_lag",
) -> DataFrame:
    """Value k calendar months earlier (rows must be a month spine)."""
    w = _by_month(key, month)
    return df.withColumns({f"{prefix}_{k}": F.lag(col, k).over(w) for k in lags})


def _rolling(aggregate: Column, col: str, size: int, w: WindowSpec) -> Column:
    frame = w.rowsBetween(1 - size, 0)
    return F.when(F.count(col).over(frame) == size, aggregate.over(frame))


def add_rolling_mean(
    df: DataFrame,
    col: str = "inflation_rate",
    sizes: Sequence[int] = (3, 6, 12),
    key: str = "country_code",
    month: str = "date",
    prefix: str = "rolling_mean",
) -> DataFrame:
    """Trailing mean including the month itself; null unless the window is full."""
    w = _by_month(key, month)
    return df.withColumns({f"{prefix}_{n}": _rolling(F.avg(col), col, n, w) for n in sizes})


def add_rolling_std(
    df: DataFrame,
    col: str = "inflation_rate",
    size: int = 6,
    key: str = "country_code",
    month: str = "date",
    prefix: str = "rolling_std",
) -> DataFrame:
    """Trailing sample deviation under the same rule."""
    w = _by_month(key, month)
    return df.withColumn(f"{prefix}_{size}", _rolling(F.stddev_samp(col), col, size, w))


def add_seasonality(df: DataFrame, month: str = "date") -> DataFrame:
    angle = month_angle(month)
    return df.withColumns({"month_sin": F.sin(angle), "month_cos": F.cos(angle)})


def add_target(
    df: DataFrame,
    col: str = "inflation_rate",
    horizon: int = 1,
    key: str = "country_code",
    month: str = "date",
    out: str = config.TARGET,
) -> DataFrame:
    """Value ``horizon`` months later."""
    return df.withColumn(out, F.lead(col, horizon).over(_by_month(key, month)))


def join_text_features(df: DataFrame, monthly: DataFrame, month: str = "date") -> DataFrame:
    """Same text row for every entity of a month.

    ``monthly`` has one row per ``yyyy-MM`` value, as ``monthly_text_features`` makes it; of several rows the
    greatest counts, and other values match no month.  That leaves at most 120,000 rows for all
    four-digit years, so they are broadcast and entities are not gathered by month.
    """
    columns = [c for c in monthly.columns if c.startswith("text_")]
    months = monthly.filter(F.col("year_month").rlike(r"^\d{4}-(0[1-9]|1[0-2])$"))
    rows = months.groupBy("year_month").agg(F.max(F.struct(F.lit(0).alias("_"), *columns)).alias("_row"))
    text = rows.select(F.col("year_month").alias("_month"), *[F.col("_row")[c].alias(c) for c in columns])
    return df.join(F.broadcast(text), year_month(month) == F.col("_month"), "left").drop("_month")


def align_annual(
    df: DataFrame,
    yearly: DataFrame,
    key: str = "country_code",
    month: str = "date",
    lag_years: int = 0,
) -> DataFrame:
    """Repeat a yearly row over its months; ``lag_years=1`` avoids look-ahead.

    The years of an entity are gathered into one row and meet its months by entity, so a panel
    that is dealt by entity already (a spine, its windows) is not shuffled again.  Several rows of one
    year multiply the months, as in any join; a month without its year stays with nulls.
    """
    values = [c for c in yearly.columns if c not in (key, month, "year", "country_name")]
    row = F.struct(F.year(month).alias("_year"), *values)
    years = yearly.groupBy(key).agg(F.collect_list(row).alias("_years"))
    kept = [c for c in df.columns if c not in values or c == key]
    fitting = F.filter("_years", lambda r: r["_year"] == F.year(month) - lag_years)
    return (
        df.join(years, key, "left")
        .select(*kept, F.explode_outer(fitting).alias("_row"))
        .select(*kept, *[F.col("_row")[c].alias(c) for c in values])
    )


def build_features(
    panel: DataFrame,
    monthly_text: DataFrame | None = None,
    yearly: DataFrame | None = None,
    cfg: dict | None = None,
    key: str = "country_code",
    month: str = "date",
    value: str = "inflation_rate",
    lag_years: int = 0,
) -> DataFrame:
    """Keys, configured features and target, one row per entity and month."""
    cfg = cfg or config.default_config()
    df = month_spine(panel, key, month, carry=[c for c in ("country_name",) if c in panel.columns])
    df = add_lags(df, value, key=key, month=month)
    df = add_rolling_mean(df, value, key=key, month=month)
    df = add_rolling_std(df, value, key=key, month=month)
    df = add_target(df, value, key=key, month=month, out=cfg["target"])
    df = add_seasonality(df, month)
    if yearly is not None:
        df = align_annual(df, yearly, key, month, lag_years)
    if monthly_text is not None:
        df = join_text_features(df, monthly_text, month)
    wanted = [*cfg["features"]["numeric"], *cfg["features"]["text"]]
    return df.select(month, key, value, *[c for c in wanted if c in df.columns], cfg["target"])


def _cutoff(df: DataFrame, date: str, months: int) -> Column:
    return months_before(one_row(df, F.max(date).alias("last"))["last"], months)


def temporal_split(
    df: DataFrame, test_months: int = 12, date: str = "date"
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cutoff and rows after it.  The cutoff is a subquery of both plans."""
    cutoff = _cutoff(df, date, test_months)
    return df.filter(F.col(date) <= cutoff), df.filter(F.col(date) > cutoff)


def temporal_split3(
    df: DataFrame, test_months: int = 12, validation_months: int = 6, date: str = "date"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation (the months before the test window) and test."""
    first = _cutoff(df, date, test_months + validation_months)
    second = _cutoff(df, date, test_months)
    d = F.col(date)
    return df.filter(d <= first), df.filter((d > first) & (d <= second)), df.filter(d > second)


def available_features(
    df: DataFrame,
    numeric: Sequence[str] = config.NUMERIC_FEATURES,
    text: Sequence[str] = config.TEXT_FEATURES,
) -> tuple[DataFrame, list[str]]:
    """Configured features that exist, in configured order, and the names that do not."""
    wanted = [*numeric, *text]
    return df.select(*[c for c in wanted if c in df.columns]), [
        c for c in wanted if c not in df.columns
    ]
