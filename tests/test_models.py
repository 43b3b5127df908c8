import datetime as dt
import math
import random
import struct

import numpy as np
import pytest
from helpers import column, plan, rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelflow import config
from panelflow.operators import evaluation, models, preprocess, quantiles, scoring, timeseries
from panelflow.session import scratch_path

D = dt.date
NAN = float("nan")


def frame(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} DOUBLE")


@pytest.mark.parametrize(
    "values",
    [[1.0], [1.0, 2.0], [5.0] * 7, [3.0, 1.0, None, 2.0, NAN], list(map(float, range(1000))), [0.0] * 500 + [1e9, -1e9]],
)
def test_exact_quantiles_match_numpy(spark, values):
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(frame(spark, values), ["x"], probs).first()["quantiles"]
    kept = [v for v in values if v is not None and v == v]
    assert np.allclose(got, np.quantile(kept, probs))


def test_exact_quantiles_on_many_columns_with_a_hot_value(spark):
    rng = random.Random(1)
    data = [(7.0 if rng.random() < 0.4 else rng.gauss(0, 100), rng.random()) for _ in range(20_000)]
    df = spark.createDataFrame(data, "x DOUBLE, y DOUBLE").repartition(8)
    got = {r["feature"]: r["quantiles"] for r in quantiles.exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75]).collect()}
    for i, c in enumerate(("x", "y")):
        assert np.allclose(got[c], np.quantile([r[i] for r in data], [0.25, 0.5, 0.75]))


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.0, 1.0 - 2**-53, 1.0 + 2**-52, 2.0, 3.0, 1.7976931348623157e308, float("inf"), float("-inf")]


def test_keys_order_as_their_values(spark):
    rng = random.Random(3)
    values = [v for e in range(-1070, 1024, 7) for v in (2.0**e, float(np.nextafter(2.0**e, 0)), -(2.0**e), float(np.nextafter(2.0**e, np.inf)))]
    values += EDGES + [struct.unpack("d", rng.randbytes(8))[0] for _ in range(5000)]
    values = [v for v in values if v == v]
    got = quantiles.with_ordered_key(frame(spark, values), "x").collect()
    ordered = sorted(got, key=lambda r: r["x"])
    for a, b in zip(ordered, ordered[1:]):
        assert (a["key"] < b["key"]) if a["x"] < b["x"] else a["key"] == b["key"]


INF = float("inf")


@pytest.mark.parametrize(
    "values, expected",
    [
        (EDGES[:-2] * 3, None),
        ([INF] * 3 + [1.0, -INF], [-INF, INF, INF]),
        ([1e-300, 1e300, 1.0], None),
        ([-1.5] * 9 + [-1.5 + 1e-12], None),
    ],
)
def test_exact_quantiles_of_extreme_values(spark, values, expected):
    got = quantiles.exact_quantiles(frame(spark, values), ["x"], [0.0, 0.5, 1.0]).first()["quantiles"]
    assert got == (expected or np.quantile(values, [0.0, 0.5, 1.0]).tolist())


def test_no_task_orders_a_slice_of_many_values(spark):
    # A million different values that share sign, exponent and the first bits of the mantissa.
    df = spark.range(1_000_000).select((F.lit(1.0) + F.col("id") * 2.0**-40).alias("x"))
    out = quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])
    assert out.first()["quantiles"] == [1.0 + (999_999 * p) * 2.0**-40 for p in (0.25, 0.5, 0.75)]
    tree = plan(out).split("\n\n")[0]
    assert tree.count("Window") > 0
    values = quantiles.with_ordered_key(quantiles.long_values(df, ["x"]))
    done = 0
    for bits in quantiles.ROUND_BITS:
        digits = values.select(F.shiftright("key", 64 - done - bits).alias("k")).distinct()
        per_prefix = digits.groupBy(F.shiftright("k", bits) if done else F.lit("all")).count()
        assert per_prefix.agg(F.max("count")).first()[0] <= 2**bits
        done += bits
    assert done == 64


@pytest.mark.parametrize("bits", [(16,) * 4, (1, 63), (40, 24)])
def test_rounds_do_not_change_quantiles(spark, monkeypatch, bits):
    monkeypatch.setattr(quantiles, "ROUND_BITS", bits)
    values = [random.Random(1).gauss(0, 1) * 10.0**k for k in range(-20, 20)] * 3
    got = quantiles.exact_quantiles(frame(spark, values), ["x"], [0.1, 0.5]).first()["quantiles"]
    assert np.allclose(got, np.quantile(values, [0.1, 0.5]), rtol=1e-14)


def test_quantiles_never_gather_or_sort_a_column(spark):
    out = quantiles.exact_quantiles(frame(spark, [1.0, 2.0]), ["x"], [0.5])
    text = plan(out)
    assert "percentile(" not in text and "CartesianProduct" not in text and "NestedLoop" not in text and "SortAggregate" not in text
    spark.sparkContext.setJobGroup("lazy", "quantiles")
    try:
        quantiles.exact_quantiles(frame(spark, [1.0, 2.0]), ["x"], [0.5])
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("lazy") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize(
    "strategy, expected", [("median", 2.5), ("mean", 3.25), ("most_frequent", 2.0), ("constant", 0.0)]
)
def test_impute(spark, strategy, expected):
    train = frame(spark, [2.0, 2.0, 3.0, 6.0, None, NAN])
    got = preprocess.impute(train, frame(spark, [None, NAN, 9.0]), ["x"], strategy)
    assert column(got, "x") == [expected, expected, 9.0]


def test_most_frequent_tie_takes_smallest(spark):
    got = preprocess.impute(frame(spark, [3.0, 1.0, 3.0, 1.0, 9.0]), frame(spark, [None]), ["x"], "most_frequent")
    assert column(got, "x") == [1.0]


def test_scalers_golden(spark):
    four = frame(spark, [1.0, 2.0, 3.0, 4.0])
    scaled = column(preprocess.scale_standard(four, four, ["x"]), "x")
    assert round(scaled[3], 7) == round(1.5 / 1.1180340, 7)
    assert column(preprocess.scale_minmax(four, four, ["x"]), "x") == [0.0, 1 / 3, 2 / 3, 1.0]
    assert column(preprocess.scale_robust(four, four, ["x"]), "x") == [-1.0, -1 / 3, 1 / 3, 1.0]


@pytest.mark.parametrize("scaler", [preprocess.scale_standard, preprocess.scale_minmax, preprocess.scale_robust])
def test_constant_column_scales_to_zero(spark, scaler):
    constant = frame(spark, [5.0, 5.0])
    assert column(scaler(constant, constant, ["x"]), "x") == [0.0, 0.0]


def wide(spark, data):
    return spark.createDataFrame(data, "inflation_lag_1 DOUBLE, gdp_growth DOUBLE, text_article_count DOUBLE, other STRING")


def test_preprocess_orders_and_drops(spark):
    train = wide(spark, [(1.0, None, 3.0, "a"), (3.0, None, None, "b")])
    out = preprocess.preprocess(train, train)
    # gdp_growth has no training value at all, so it is dropped; text is not scaled.
    assert out.columns == ["inflation_lag_1", "text_article_count"]
    assert rows(out) == [(-1.0, 3.0), (1.0, 0.0)]


@pytest.mark.parametrize("scaler", ["standard", "minmax", "robust", "none"])
def test_lazy_and_fitted_preprocessing_agree(spark, scaler):
    rng = random.Random(5)
    data = [(rng.gauss(0, 5) if rng.random() > 0.2 else None, rng.random(), 1.0, "z") for _ in range(200)]
    df = wide(spark, data)
    cfg = config.default_config()
    cfg["preprocessing"]["numeric"]["scaler"] = scaler
    fitted = preprocess.preprocess(df, df, cfg)
    cols = ["inflation_lag_1", "gdp_growth"]
    lazy = preprocess.impute(df, df, cols)
    if scaler != "none":
        lazy = getattr(preprocess, f"scale_{scaler}")(lazy, lazy, cols)
    assert np.allclose(np.array(rows(fitted.select(*cols))), np.array(rows(lazy.select(*cols))))


def trend(spark, n=96):
    """Countries with trend and season.  Levels overlap: trees cannot continue a trend
    beyond the levels they were trained on."""
    data = [
        (c, D(2015 + m // 12, m % 12 + 1, 1), level + slope * m + 3 * math.sin(2 * math.pi * m / 12))
        for c, level, slope in (("A", 3, 0.03), ("B", 8, -0.03), ("C", 5, 0.01), ("D", 4, 0.02))
        for m in range(n)
    ]
    df = spark.createDataFrame(data, "country_code STRING, date DATE, inflation_rate DOUBLE")
    return timeseries.build_features(df)


def small(algorithm):
    cfg = config.default_config()
    cfg["model"]["algorithm"] = algorithm
    cfg["model"]["hyperparameters"].update({"n_estimators": 20, "max_depth": 5})
    return cfg


@pytest.fixture(scope="module")
def parts(spark):
    return [p.persist() for p in timeseries.temporal_split(trend(spark))]


@pytest.fixture(scope="module")
def forest(parts):
    return models.train_model(parts[0], small("random_forest"))


def rmse(df, predicted):
    e = F.col(config.TARGET) - F.col(predicted)
    return df.filter(F.col(config.TARGET).isNotNull()).agg(F.sqrt(F.avg(e * e))).first()[0]


@pytest.mark.parametrize("train", [models.train_random_forest, models.train_gbt, models.train_default])
def test_models_beat_last_value(parts, train):
    model = train(parts[0], small("any"))
    assert rmse(model.transform(parts[0]), "prediction") < 0.5 * rmse(parts[0], "inflation_rate")
    assert rmse(model.transform(parts[1]), "prediction") < rmse(parts[1], "inflation_rate")


def test_model_survives_saving(spark, parts, forest):
    path = scratch_path(spark, "model")
    forest.write().save(path)
    loaded = PipelineModel.load(path)
    before = column(forest.transform(parts[1]).orderBy("country_code", "date"), "prediction")
    assert column(loaded.transform(parts[1]).orderBy("country_code", "date"), "prediction") == before


def test_importances(forest):
    out = scoring.feature_importance(forest, 5).collect()
    assert len(out) == 5 and [r["importance"] for r in out] == sorted((r["importance"] for r in out), reverse=True)


def test_unknown_algorithm_is_default_forest():
    regressor = models.build_regressor(small("what"))
    assert regressor.getNumTrees() == models.DEFAULT_TREES and regressor.getFeatureSubsetStrategy() == "all"


def test_search_uses_the_validation_window(spark):
    train, validation, _ = timeseries.temporal_split3(trend(spark))
    out = models.search_hyperparameters(train, validation, [{"max_depth": 1}, {"max_depth": 5}], small("random_forest"))
    errors = column(out, "rmse")
    assert len(errors) == 2 and errors == sorted(errors) and errors[0] > 0


def test_score_batch_rounds_and_labels(parts, forest):
    row = scoring.score_batch(forest, parts[1], ["inflation_lag_1"], ["country_code"]).first()
    assert row["model_version"] == "unknown" and row["prediction"] == round(row["prediction"], 4)


def test_validate_features(spark):
    df = spark.createDataFrame([(1.0, "z"), (NAN, "z"), (float("inf"), "z"), (None, "z")], "a DOUBLE, extra STRING")
    ok, rejected, extra = scoring.validate_features(df, ["a"])
    assert column(ok, "a") == [1.0] and extra == ["extra"]
    assert sorted(column(rejected, "reason")) == ["a contains invalid value"] * 2 + ["a must be numeric"]
    with pytest.raises(ValueError, match="Missing"):
        scoring.validate_features(df, ["a", "b"])
    assert scoring.validate_features(df, ["extra"])[0].count() == 0


def test_metadata_counts(parts):
    row = scoring.training_metadata(config.default_config(), *parts).first()
    assert row["train_samples"] == parts[0].count() and row["test_samples"] == parts[1].count()
    assert '"test_months": 12' in row["split"]
    cfg = config.default_config()
    unlabelled = parts[0].limit(1).withColumn(cfg["target"], F.lit(None).cast("double"))
    more = parts[0].unionByName(unlabelled).withColumn("gdp_growth", F.lit(None).cast("double"))
    again = scoring.training_metadata(cfg, more, parts[1]).first()
    assert again["train_samples"] == row["train_samples"]
    dropped = int("gdp_growth" in parts[0].columns)
    assert again["feature_count"] == row["feature_count"] - dropped


def test_model_info_keeps_runs_without_metrics(spark, parts):
    metadata = scoring.training_metadata(config.default_config(), *parts)
    columns = "model_version STRING, rmse DOUBLE, mae DOUBLE, r2 DOUBLE, mape DOUBLE, directional_accuracy DOUBLE"
    for version, rmse in (("v1.0.0", 1.0), ("other", None)):
        info = scoring.model_info(metadata, spark.createDataFrame([(version, 1.0, 1.0, 1.0, 1.0, 1.0)], columns)).collect()
        assert [r["rmse"] for r in info] == [rmse]


def predictions(spark, data):
    return spark.createDataFrame(
        [(c, D(2000, 1, 1) + dt.timedelta(days=40 * i), y, p) for c, i, y, p in data],
        "country_code STRING, date DATE, actual DOUBLE, predicted DOUBLE",
    )


def test_mape_with_zero_actual(spark):
    got = evaluation.mape(predictions(spark, [("A", 0, 0.0, 1e-8)])).first()["mape"]
    assert abs(got - 100.0) < 1e-6


def test_metrics_of_constant_actual(spark):
    perfect = evaluation.regression_metrics(predictions(spark, [("A", 0, 1.0, 1.0), ("A", 1, 1.0, 1.0)])).first()
    assert (perfect["r2"], perfect["explained_variance"]) == (1.0, 1.0)
    wrong = evaluation.regression_metrics(predictions(spark, [("A", 0, 1.0, 2.0), ("A", 1, 1.0, 3.0)])).first()
    assert (wrong["r2"], wrong["explained_variance"]) == (0.0, 0.0)


def test_directional_accuracy_cases(spark):
    single = predictions(spark, [("A", 0, 1.0, 1.0), ("B", 0, 1.0, 1.0)])
    assert evaluation.directional_accuracy(single).first()[0] is None


def test_directional_accuracy_across_years_equals_brute_force(spark):
    rng = random.Random(2)
    data = [(c, i, float(rng.randrange(5)), float(rng.randrange(5))) for c in "ABC" for i in range(60)]
    hits = pairs = 0
    for c in "ABC":
        own = [r for r in data if r[0] == c]
        for a, b in zip(own, own[1:]):
            pairs += 1
            hits += (b[2] > a[2]) == (b[3] > a[3])
    got = evaluation.directional_accuracy(predictions(spark, data).repartition(8)).first()[0]
    assert abs(got - hits / pairs) < 1e-12


def test_histogram_edges(spark):
    out = evaluation.residual_histogram(frame(spark, [0.0, 20.0, 10.0, 9.99], "residual")).orderBy("bin").collect()
    assert len(out) == 20 and out[19]["count"] == 1 and out[10]["count"] == 1 and out[9]["count"] == 1
    flat = evaluation.residual_histogram(frame(spark, [3.0, 3.0], "residual"), bins=4).orderBy("bin").collect()
    assert (flat[0]["low"], flat[3]["high"], sum(r["count"] for r in flat)) == (2.5, 3.5, 2)


def test_bands_golden(spark):
    out = evaluation.inflation_band(frame(spark, [-0.1, 0.0, 3.0, 10.0, None], "prediction"))
    assert column(out, "band") == ["deflation", "low/moderate", "high", "very high", None]


def test_report_is_one_row(spark):
    out = evaluation.metrics_report(predictions(spark, [("A", 0, 1.0, 2.0), ("A", 1, 2.0, 3.0)]), config.default_config())
    row = out.first()
    assert row["rmse"] == 1.0 and row["directional_accuracy"] == 1.0 and row["timestamp"] is not None
