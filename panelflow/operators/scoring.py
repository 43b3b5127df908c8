"""Batch scoring, input validation, importances and run metadata."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from panelflow.functions.numbers import half_even, nan_to_null, one_row


def validate_features(
    df: DataFrame, expected: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """``(ok, rejected, extra columns)``.

    A missing column is an error; extra columns are reported.  Rows whose feature is not
    numeric, missing, NaN or infinite are rejected with a reason.
    """
    kinds = {f.name: isinstance(f.dataType, NumericType) for f in df.schema}
    if absent := sorted(set(expected) - set(kinds)):
        raise ValueError(f"Missing columns that the model was fitted on: {', '.join(absent)}")
    extra = [c for c in kinds if c not in set(expected)]
    numeric = {c for c, is_number in kinds.items() if is_number}
    reasons = []
    for c in expected:
        if c not in numeric:
            reasons.append(F.lit(f"{c} must be numeric"))
            continue
        x = F.col(c).cast("double")
        infinite = x.isin(float("inf"), float("-inf"))
        reasons.append(F.when(x.isNull(), F.lit(f"{c} must be numeric")))
        reasons.append(F.when(F.isnan(x) | infinite, F.lit(f"{c} contains invalid value")))
    checked = df.withColumn("reason", F.coalesce(*reasons))
    ok = checked.filter("reason IS NULL").drop("reason")
    return ok, checked.filter("reason IS NOT NULL"), extra


def score_batch(
    model: Model,
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] = (),
    metadata: dict | None = None,
) -> DataFrame:
    """Rounded predictions with the model version and the echoed, rounded inputs."""
    version = (metadata or {}).get("model_version", "unknown")
    return model.transform(df).select(
        *keys,
        half_even(F.col("prediction")).alias("prediction"),
        F.lit(version).alias("model_version"),
        *[half_even(F.col(c).cast("double")).alias(c) for c in features],
    )


def feature_importance(model: PipelineModel, k: int = 20) -> DataFrame | None:
    """Top features of a fitted pipeline, ties by name; ``None`` for models without any."""
    regressor = model.stages[-1]
    if not hasattr(regressor, "featureImportances"):
        return None
    names = model.stages[0].feature_names()
    weights = [float(w) for w in regressor.featureImportances.toArray()]
    rows = sorted(zip(names, weights, strict=True), key=lambda r: (-r[1], r[0]))[:k]
    return SparkSession.active().createDataFrame(rows, "feature STRING, importance DOUBLE")


def training_metadata(
    cfg: dict, train: DataFrame, test: DataFrame, features: Sequence[str] | None = None
) -> DataFrame:
    """One row describing a training run; counts are subqueries of it.

    ``train_samples`` counts the rows that are fitted, those with a target; ``feature_count``
    the features that the preprocessor keeps: one imputed from the data is dropped if no
    fitted row has a value.  ``test_samples`` counts the rows of the test part.
    """
    if features is None:
        wanted = [*cfg["features"]["numeric"], *cfg["features"]["text"]]
        features = [c for c in wanted if c in train.columns]
    constant = [g for g in ("numeric", "text") if cfg["preprocessing"][g].get("imputer_strategy") == "constant"]
    always = {c for g in constant for c in cfg["features"][g]}
    kept = F.lit(len([c for c in features if c in always]))
    for c in features:
        if c not in always:
            kept = kept + (F.count(nan_to_null(F.col(c).cast("double"))) > 0).cast("int")
    rows = F.count(F.lit(1)).alias("n")
    fitted = one_row(train.filter(F.col(cfg["target"]).isNotNull()), rows, kept.alias("kept"))
    documents = {
        "hyperparameters": cfg["model"].get("hyperparameters", {}),
        "features": cfg["features"],
        "preprocessing": cfg["preprocessing"],
        "split": cfg["split"],
    }
    return train.sparkSession.range(1).select(
        F.lit(cfg["versioning"]["model_version"]).alias("model_version"),
        F.lit(cfg["versioning"]["experiment_name"]).alias("experiment_name"),
        F.lit(cfg["model"]["algorithm"]).alias("algorithm"),
        F.lit(cfg["target"]).alias("target"),
        *[F.lit(json.dumps(v, sort_keys=True)).alias(k) for k, v in documents.items()],
        fitted["n"].alias("train_samples"),
        one_row(test, rows)["n"].alias("test_samples"),
        fitted["kept"].alias("feature_count"),
    )


def model_info(metadata: DataFrame, metrics: DataFrame) -> DataFrame:
    """What a served model reports: version, algorithm, counts and, once evaluated, metrics.

    One row per row of ``metadata``; metrics of its version, or null before an evaluation.
    """
    described = metadata.select("model_version", "algorithm", "target", "train_samples", "test_samples", "feature_count")
    measured = metrics.select("model_version", "rmse", "mae", "r2", "mape", "directional_accuracy")
    return described.join(measured, "model_version", "left")
