"""The four batch jobs end to end, each reading and writing tables under one folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflow import config
from panelflow.operators import (
    catalog,
    evaluation,
    models,
    monthly,
    panel,
    scoring,
    text,
    tfidf,
    timeseries,
)
from panelflow.sources import files, indicators

BASE_INDICATOR, BASE_COLUMN = "inflation", "inflation_rate"
OTHER_INDICATORS = {"gdp_growth": "gdp_growth", "interest_rate": "interest_rate"}


def build_panel(
    pages: DataFrame,
    countries: DataFrame,
    out: str,
    others: Mapping[str, str] = OTHER_INDICATORS,
) -> DataFrame:
    """Landed indicator pages to ``series``, ``panel``, ``report`` and ``rejects``.

    ``countries`` lists the expected ``country_code`` values; ``others`` maps further
    indicators to their panel columns.
    """
    spark = pages.sparkSession
    records, rejects = indicators.parse_indicator_payload(pages)
    files.write_panel(
        panel.indicator_series(records),
        f"{out}/series",
        partition_by=["indicator"],
        sort_by=["country_code", "date"],
    )
    files.write_json_report(rejects, f"{out}/rejects")
    series = spark.read.parquet(f"{out}/series")
    merged = panel.merge_indicators(
        panel.series_column(series, BASE_INDICATOR, BASE_COLUMN),
        {c: panel.series_column(series, i, c) for i, c in others.items()},
    )
    files.write_panel(panel.master_panel([merged], ordered=False), f"{out}/panel", sort_by=["country_code", "date"])
    expected = [BASE_INDICATOR, *others]
    files.write_json_report(catalog.series_report(series, countries, expected), f"{out}/report")
    return spark.read.parquet(f"{out}/panel")


def process_pages(
    pages: DataFrame, out: str, key: str = "html_path", **options
) -> tuple[DataFrame, DataFrame]:
    """Raw pages to ``articles``, ``monthly`` and ``summary``; options as ``article_features``."""
    spark = pages.sparkSession
    files.write_panel(
        tfidf.corpus_features(text.article_features(pages, key=key, **options), key), f"{out}/articles"
    )
    articles = spark.read.parquet(f"{out}/articles")
    files.write_panel(
        monthly.monthly_text_features(monthly.parse_published(articles)), f"{out}/monthly"
    )
    months = spark.read.parquet(f"{out}/monthly")
    files.write_json_report(monthly.text_summary(articles, months), f"{out}/summary")
    return articles, months


def train(features: DataFrame, out: str, cfg: dict | None = None, exact: bool = True) -> PipelineModel:
    """Split by time, fit, and save ``model``, ``metadata``, ``train`` and ``test``.

    Rows without target stay in the splits; they are left out of the fit.
    """
    cfg = cfg or config.default_config()
    parts = timeseries.temporal_split(features, cfg["split"]["test_months"])
    for name, part in zip(("train", "test"), parts, strict=True):
        files.write_panel(part, f"{out}/{name}")
    spark = features.sparkSession
    rows, test = (spark.read.parquet(f"{out}/{name}") for name in ("train", "test"))
    model = models.train_model(rows, cfg, exact)
    model.write().overwrite().save(f"{out}/model")
    files.write_json_report(scoring.training_metadata(cfg, rows, test), f"{out}/metadata")
    return model


def predict(model: PipelineModel, features: DataFrame, cfg: dict, key: str = "country_code") -> DataFrame:
    """Predictions table of the rows whose target is known."""
    target = F.col(cfg["target"])
    return (
        model.transform(features)
        .filter(target.isNotNull())
        .select(key, "date", target.alias("actual"), F.col("prediction").alias("predicted"))
    )


def evaluate(spark: SparkSession, out: str, cfg: dict | None = None) -> DataFrame:
    """Score the saved test rows; writes ``predictions``, ``residuals``, ``histogram``,
    ``importance`` and ``metrics``."""
    cfg = cfg or config.default_config()
    model = PipelineModel.load(f"{out}/model")
    files.write_panel(predict(model, spark.read.parquet(f"{out}/test"), cfg), f"{out}/predictions")
    predictions = spark.read.parquet(f"{out}/predictions")
    residuals = evaluation.prediction_residuals(predictions)
    files.write_panel(residuals, f"{out}/residuals")
    files.write_json_report(evaluation.residual_histogram(residuals), f"{out}/histogram")
    importance = scoring.feature_importance(model)
    if importance is not None:
        files.write_json_report(importance, f"{out}/importance")
    files.write_json_report(evaluation.metrics_report(predictions, cfg), f"{out}/metrics")
    return spark.read.json(f"{out}/metrics")


def score(
    spark: SparkSession, features: DataFrame, out: str, keys: Sequence[str] = ("country_code", "date")
) -> tuple[DataFrame, DataFrame]:
    """Score new rows with the saved model: ``(scored, rejected)``.

    Rows must bring every feature the model was trained on, each a finite number.
    """
    model = PipelineModel.load(f"{out}/model")
    names = model.stages[0].feature_names()
    metadata = spark.read.json(f"{out}/metadata").select("model_version").first()
    ok, rejected, _ = scoring.validate_features(features, names)
    scored = scoring.score_batch(model, ok, names, keys, metadata.asDict() if metadata else None)
    target_month = F.add_months("date", 1).alias("target_month")
    return (scored.select("*", target_month) if "date" in keys else scored), rejected


__all__ = ["build_panel", "evaluate", "predict", "process_pages", "score", "train"]
