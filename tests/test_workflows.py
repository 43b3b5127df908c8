"""The four jobs over the given tables, writing to the shared folder."""

import copy
import os

import pytest
from pyspark.sql import functions as F

from panelflow import config, workflows
from panelflow.operators import timeseries
from panelflow.plans import bindings as B
from panelflow.session import scratch_path

pytestmark = pytest.mark.skipif(
    not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not there"
)


def test_jobs_end_to_end(spark, sf):
    out = scratch_path(spark, "jobs")
    yearly = workflows.build_panel(B.indicator_pages(spark, sf), B.nations(spark, sf), f"{out}/indicators")
    assert yearly.count() > 0
    assert spark.read.json(f"{out}/indicators/rejects").count() == 25
    report = spark.read.json(f"{out}/indicators/report")
    assert report.count() == 75 and report.filter("status = 'success'").count() > 0

    lexicons = {"categories": B.CATEGORIES, "positive": B.POSITIVE, "negative": B.NEGATIVE}
    articles, months = workflows.process_pages(B.raw_pages(spark, sf), f"{out}/text", **lexicons)
    assert articles.filter("tfidf_mean > 0").count() > 0
    assert months.agg(F.sum("text_article_count")).first()[0] == articles.count()
    assert spark.read.json(f"{out}/text/summary").first()["articles"] == articles.count()

    annual = yearly.select("country_code", "date", "gdp_growth", "interest_rate")
    features = timeseries.build_features(B.panel(spark, sf), months, annual)
    cfg = copy.deepcopy(config.default_config())
    cfg["model"]["algorithm"] = "random_forest"
    cfg["model"]["hyperparameters"].update({"n_estimators": 10, "max_depth": 4})
    model = workflows.train(features, f"{out}/model", cfg)
    assert len(model.stages) == 2
    metrics = workflows.evaluate(spark, f"{out}/model", cfg)
    row = metrics.first()
    assert row["rmse"] > 0 and row["algorithm"] == "random_forest"
    assert spark.read.json(f"{out}/model/histogram").agg(F.sum("count")).first()[0] == (
        spark.read.parquet(f"{out}/model/predictions").count()
    )

    scored, rejected = workflows.score(spark, features, f"{out}/model")
    assert scored.count() + rejected.count() == features.count()
    assert rejected.count() > 0 and "target_month" in scored.columns
