"""Evaluation of a predictions table ``(key, date, actual, predicted)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflow.functions.numbers import one_row

SMALLEST_DENOMINATOR = 1e-8


def _regression(y: Column, p: Column) -> dict[str, Column]:
    error = y - p
    mse = F.avg(error * error)
    spread, noise = F.var_pop(y), F.var_pop(error)
    perfect = F.lit(1.0)
    none = F.lit(0.0)
    r2 = F.when(spread > 0, 1 - mse / spread).otherwise(F.when(mse == 0, perfect).otherwise(none))
    explained = F.when(spread > 0, 1 - noise / spread).otherwise(
        F.when(noise == 0, perfect).otherwise(none)
    )
    return {"rmse": F.sqrt(mse), "mae": F.avg(F.abs(error)), "r2": r2, "explained_variance": explained}


def _mape(y: Column, p: Column) -> Column:
    return 100 * F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(SMALLEST_DENOMINATOR)))


def _distribution(y: Column, p: Column) -> dict[str, Column]:
    return {
        "mean_actual": F.avg(y),
        "std_actual": F.stddev_pop(y),
        "mean_predicted": F.avg(p),
        "std_predicted": F.stddev_pop(p),
    }


def _complete(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())


def _aggregate(
    df: DataFrame, metrics: dict[str, Column], by: str | Sequence[str] | None
) -> DataFrame:
    keys = [by] if isinstance(by, str) else list(by or [])
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in metrics.items()])


def regression_metrics(
    df: DataFrame, y: str = "actual", yhat: str = "predicted", by: str | Sequence[str] | None = None
) -> DataFrame:
    """RMSE, MAE, R2 and explained variance in one pass."""
    return _aggregate(_complete(df, y, yhat), _regression(F.col(y), F.col(yhat)), by)


def mape(
    df: DataFrame, y: str = "actual", yhat: str = "predicted", by: str | Sequence[str] | None = None
) -> DataFrame:
    return _aggregate(_complete(df, y, yhat), {"mape": _mape(F.col(y), F.col(yhat))}, by)


def distribution_stats(
    df: DataFrame, y: str = "actual", yhat: str = "predicted", by: str | Sequence[str] | None = None
) -> DataFrame:
    """Mean and population deviation of both sides."""
    return _aggregate(_complete(df, y, yhat), _distribution(F.col(y), F.col(yhat)), by)


def direction_hits(
    df: DataFrame,
    key: str = "country_code",
    date: str = "date",
    y: str = "actual",
    yhat: str = "predicted",
) -> DataFrame:
    """``(hits, pairs)`` summed over consecutive rows per entity.

    Rows are compared inside (entity, year) windows, so a long series is spread over
    tasks.  The pairs across years come from one first and one last row per (entity,
    year), compared in a second, much smaller window.
    """

    def agrees(prior_y: Column, prior_p: Column, next_y: Column, next_p: Column) -> Column:
        return ((next_y > prior_y) == (next_p > prior_p)).cast("bigint")

    rows = _complete(df, y, yhat).select(
        key, F.year(date).alias("_year"), F.col(date).alias("_at"), F.col(y).alias("_y"), F.col(yhat).alias("_p")
    )
    year = Window.partitionBy(key, "_year").orderBy("_at")
    here = F.struct("_at", "_y", "_p")
    per_year = (
        rows.withColumn("_before", F.lag(here).over(year))
        .withColumn("_row", here)
        .groupBy(key, "_year")
        .agg(
            F.sum(agrees(F.col("_before._y"), F.col("_before._p"), F.col("_y"), F.col("_p"))).alias("hits"),
            F.count("_before").alias("pairs"),
            F.min_by("_row", "_at").alias("first"),
            F.max_by("_row", "_at").alias("last"),
        )
    )
    seam = F.lag("last").over(Window.partitionBy(key).orderBy("_year"))
    crossing = agrees(F.col("seam._y"), F.col("seam._p"), F.col("first._y"), F.col("first._p"))
    return (
        per_year.withColumn("seam", seam)
        .agg(
            (F.coalesce(F.sum("hits"), F.lit(0)) + F.coalesce(F.sum(crossing), F.lit(0))).alias("hits"),
            (F.coalesce(F.sum("pairs"), F.lit(0)) + F.count("seam")).alias("pairs"),
        )
    )


def directional_accuracy(
    df: DataFrame,
    key: str = "country_code",
    date: str = "date",
    y: str = "actual",
    yhat: str = "predicted",
) -> DataFrame:
    """Share of consecutive pairs with the same direction, pooled over entities."""
    hits = direction_hits(df, key, date, y, yhat)
    return hits.select(
        F.when(F.col("pairs") > 0, F.col("hits") / F.col("pairs")).alias("directional_accuracy")
    )


def prediction_residuals(
    df: DataFrame, keys: Sequence[str] = ("country_code", "date"), y: str = "actual", yhat: str = "predicted"
) -> DataFrame:
    return df.select(
        *keys,
        F.col(y).alias("actual"),
        F.col(yhat).alias("predicted"),
        (F.col(y) - F.col(yhat)).alias("residual"),
    )


def residual_histogram(df: DataFrame, bins: int = 20, residual: str = "residual") -> DataFrame:
    """``(bin, low, high, count)``; the last bin is closed and empty bins are present."""
    rows = df.filter(F.col(residual).isNotNull())
    ends = one_row(rows, F.min(residual).alias("lo"), F.max(residual).alias("hi"))
    flat = ends["lo"] == ends["hi"]
    low = F.when(flat, ends["lo"] - 0.5).otherwise(ends["lo"])
    high = F.when(flat, ends["hi"] + 0.5).otherwise(ends["hi"])
    width = (high - low) / bins
    index = F.least(F.floor((F.col(residual) - low) / width), F.lit(bins - 1)) + 1
    counts = rows.groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + width * (F.col("bin") - 1)).alias("low"),
        (low + width * F.col("bin")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def prediction_extent(df: DataFrame, y: str = "actual", yhat: str = "predicted") -> DataFrame:
    """End points of the identity line and R2."""
    a, p = F.col(y), F.col(yhat)
    return _complete(df, y, yhat).agg(
        F.least(F.min(a), F.min(p)).alias("low"),
        F.greatest(F.max(a), F.max(p)).alias("high"),
        _regression(a, p)["r2"].alias("r2"),
    )


def forecast_series(
    df: DataFrame, key: str = "country_code", date: str = "date", y: str = "actual", yhat: str = "predicted"
) -> DataFrame:
    return df.select(key, date, F.col(y).alias("actual"), F.col(yhat).alias("predicted")).orderBy(key, date)


def metrics_report(
    df: DataFrame,
    cfg: dict,
    key: str = "country_code",
    date: str = "date",
    y: str = "actual",
    yhat: str = "predicted",
    timestamp: bool = True,
) -> DataFrame:
    """All metrics and run labels as one row."""
    a, p = F.col(y), F.col(yhat)
    metrics = {**_regression(a, p), "mape": _mape(a, p), **_distribution(a, p)}
    hits = direction_hits(df, key, date, y, yhat).select(F.struct("hits", "pairs")).scalar()
    labels = {
        "model_version": cfg["versioning"]["model_version"],
        "dataset": cfg["versioning"]["experiment_name"],
        "algorithm": cfg["model"]["algorithm"],
    }
    extra = [F.current_timestamp().alias("timestamp")] if timestamp else []
    return _aggregate(_complete(df, y, yhat), metrics, None).select(
        "*",
        F.when(hits["pairs"] > 0, hits["hits"] / hits["pairs"]).alias("directional_accuracy"),
        *[F.lit(v).alias(k) for k, v in labels.items()],
        *extra,
    )


def inflation_band(df: DataFrame, col: str = "prediction", out: str = "band") -> DataFrame:
    x = F.col(col)
    return df.withColumn(
        out,
        F.when(x < 0, "deflation").when(x < 3, "low/moderate").when(x < 10, "high").when(x.isNotNull(), "very high"),
    )


def band_counts(df: DataFrame, col: str = "prediction") -> DataFrame:
    return inflation_band(df, col).groupBy("band").agg(F.count(F.lit(1)).alias("n"))
