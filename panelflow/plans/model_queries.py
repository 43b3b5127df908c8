"""Queries for preprocessing, training, scoring and evaluation."""

from __future__ import annotations

import copy

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from panelflow import config
from panelflow.operators import evaluation, models, preprocess, scoring, timeseries
from panelflow.plans import bindings as B
from panelflow.plans import oracle as O
from panelflow.plans.panel_queries import numeric_features, spine, yearly
from panelflow.plans.registry import query, select
from panelflow.plans.text_queries import monthly_features
from panelflow.session import materialize

_KEYS = "country_code:s date:d "
COLUMNS = [c for c in config.NUMERIC_FEATURES if not c.startswith("month_")]
_OUT = _KEYS + " ".join(f"{c}:f" for c in COLUMNS)


def _split_ctes(source: dict[str, str], table: str) -> dict[str, str]:
    return {
        **source,
        "cutoff": f"SELECT max(date) - INTERVAL 12 MONTH AS cut FROM {table}",
        "train": f"SELECT t.* FROM {table} t, cutoff WHERE date <= cut",
        "test": f"SELECT t.* FROM {table} t, cutoff WHERE date > cut",
    }


_NUMERIC = _split_ctes(O.NUMERIC, "aligned")


def _fitted(columns, fit: str, formula: str, source: str = "train") -> str:
    """``formula`` per column over test rows, with ``fit`` (several aggregates) of the source."""
    stats = ", ".join(fit.format(c=c) for c in columns)
    exprs = ", ".join(formula.format(c=c) + f" AS {c}" for c in columns)
    return f"SELECT country_code, date, {exprs} FROM test, (SELECT {stats} FROM {source}) AS fitted"


def _parts(spark, sf):
    """Training and test rows of the numeric feature table, which is written first."""
    return timeseries.temporal_split(materialize(numeric_features(spark, sf)))


def _keyed(df):
    return df.select("country_code", "date", *COLUMNS)


def _impute(spark, sf, strategy: str):
    train, test = _parts(spark, sf)
    return _keyed(preprocess.impute(train, test, COLUMNS, strategy))


@query(
    "impute_median",
    select(
        _OUT,
        _fitted(COLUMNS, "quantile_cont({c}, 0.5) AS fill_{c}", "coalesce({c}, fill_{c})"),
        O.chain(_NUMERIC),
    ),
)
def impute_median(spark, sf):
    return _impute(spark, sf, "median")


@query(
    "impute_mean",
    select(_OUT, _fitted(COLUMNS, "avg({c}) AS fill_{c}", "coalesce({c}, fill_{c})"), O.chain(_NUMERIC)),
)
def impute_mean(spark, sf):
    return _impute(spark, sf, "mean")


_MODES = {
    f"mode_{c}": f"SELECT {c} AS fill_{c} FROM train WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1"
    for c in COLUMNS
}


@query(
    "impute_most_frequent",
    select(
        _OUT,
        "SELECT country_code, date, "
        + ", ".join(f"coalesce({c}, fill_{c}) AS {c}" for c in COLUMNS)
        + " FROM test, "
        + ", ".join(_MODES),
        O.chain(_NUMERIC, _MODES),
    ),
)
def impute_most_frequent(spark, sf):
    return _impute(spark, sf, "most_frequent")


@query(
    "impute_constant",
    select(
        _OUT,
        "SELECT country_code, date, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in COLUMNS) + " FROM test",
        O.chain(_NUMERIC),
    ),
)
def impute_constant(spark, sf):
    return _impute(spark, sf, "constant")


@query(
    "scale_standard",
    select(
        _OUT,
        _fitted(COLUMNS, "avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}", "({c} - m_{c}) / s_{c}"),
        O.chain(_NUMERIC),
    ),
)
def scale_standard(spark, sf):
    train, test = _parts(spark, sf)
    return _keyed(preprocess.scale_standard(train, test, COLUMNS))


@query(
    "scale_minmax",
    select(
        _OUT,
        _fitted(COLUMNS, "min({c}) AS m_{c}, max({c}) - min({c}) AS s_{c}", "({c} - m_{c}) / s_{c}"),
        O.chain(_NUMERIC),
    ),
)
def scale_minmax(spark, sf):
    train, test = _parts(spark, sf)
    return _keyed(preprocess.scale_minmax(train, test, COLUMNS))


@query(
    "scale_robust",
    select(
        _OUT,
        _fitted(
            COLUMNS,
            "quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}",
            "({c} - m_{c}) / s_{c}",
        ),
        O.chain(_NUMERIC),
    ),
)
def scale_robust(spark, sf):
    train, test = _parts(spark, sf)
    return _keyed(preprocess.scale_robust(train, test, COLUMNS))


_ALL_NUMERIC, _TEXT = config.NUMERIC_FEATURES, config.TEXT_FEATURES
_PREPARED = {
    **_split_ctes(O.FEATURE_TABLE, "feature_table"),
    "fills": "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS fill_{c}" for c in _ALL_NUMERIC) + " FROM train",
    "filled": "SELECT " + ", ".join(f"coalesce({c}, fill_{c}) AS {c}" for c in _ALL_NUMERIC) + " FROM train, fills",
    "fitted": "SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _ALL_NUMERIC)
    + " FROM filled",
}


@query(
    "preprocess",
    select(
        " ".join(f"{c}:f" for c in [*_ALL_NUMERIC, *_TEXT]),
        "SELECT "
        + ", ".join(f"(coalesce({c}, fill_{c}) - m_{c}) / s_{c} AS {c}" for c in _ALL_NUMERIC)
        + ", "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _TEXT)
        + " FROM test, fills, fitted",
        O.chain(_PREPARED),
    ),
)
def preprocess_features(spark, sf):
    train, test = timeseries.temporal_split(_features(spark, sf))
    return preprocess.preprocess(train, test)


def _features(spark, sf):
    """The whole feature table, written first."""
    return materialize(timeseries.build_features(B.panel(spark, sf), monthly_features(spark, sf), yearly(spark, sf)))


def _configured(algorithm: str) -> dict:
    """The default configuration; a forest is 10 deep, the default forest unbounded."""
    cfg = copy.deepcopy(config.default_config())
    cfg["model"]["algorithm"] = algorithm
    depths = {"xgboost": 6, "random_forest": 10, "default": models.DEEPEST}
    cfg["model"]["hyperparameters"]["max_depth"] = depths[algorithm]
    return cfg


def _predict(model, test):
    features = [c for c in [*_ALL_NUMERIC, *_TEXT] if c in test.columns]
    return scoring.score_batch(
        model, test, features, ["country_code", "date"], {"model_version": "v1.0.0"}
    )


@query("train_random_forest")
def train_random_forest(spark, sf):
    train, test = timeseries.temporal_split(_features(spark, sf))
    return _predict(models.train_random_forest(train, _configured("random_forest")), test)


@query("train_gbt")
def train_gbt(spark, sf):
    train, test = timeseries.temporal_split(_features(spark, sf))
    return _predict(models.train_gbt(train, _configured("xgboost")), test)


@query("train_default")
def train_default(spark, sf):
    train, test = timeseries.temporal_split(_features(spark, sf))
    return _predict(models.train_default(train, _configured("default")), test)


GRID = [{"max_depth": depth, "n_estimators": trees} for depth in (4, 6, 10) for trees in (100, 200)]


@query("search_hyperparameters")
def search_hyperparameters(spark, sf):
    train, validation, _ = timeseries.temporal_split3(_features(spark, sf))
    return models.search_hyperparameters(train, validation, GRID, _configured("random_forest"))


@query("feature_importance")
def feature_importance(spark, sf):
    train, _ = timeseries.temporal_split(_features(spark, sf))
    return scoring.feature_importance(models.train_model(train, _configured("random_forest")), 20)


def linear_model():
    statement = "SELECT *, 0.6D * inflation_lag_1 + 0.4D * rolling_mean_3 AS prediction FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=statement)])


_SCORED = ["inflation_lag_1", "rolling_mean_3", "month_sin"]


@query(
    "score_batch",
    select(
        _KEYS + "prediction:f model_version:s " + " ".join(f"{c}:f" for c in _SCORED),
        "SELECT country_code, date, round_even(0.6::DOUBLE * inflation_lag_1 + 0.4::DOUBLE * rolling_mean_3, 4) AS prediction, "
        "'v1.0.0' AS model_version, " + ", ".join(f"round_even({c}, 4) AS {c}" for c in _SCORED) + " FROM test",
        O.chain(_NUMERIC),
    ),
)
def score_batch(spark, sf):
    _, test = _parts(spark, sf)
    return scoring.score_batch(
        linear_model(), test, _SCORED, ["country_code", "date"], {"model_version": "v1.0.0"}
    )


_CHECKED = ["inflation_lag_1", "inflation_lag_12", "rolling_mean_3"]
_REASON = (
    "CASE " + " ".join(
        f"WHEN {c} IS NULL THEN '{c} must be numeric' WHEN isinf({c}) THEN '{c} contains invalid value'" for c in _CHECKED
    ) + " END AS reason"
)
# Rates of the largest month of a country become infinite, to have such a case.
_SPOILED = {
    **O.WINDOWED,
    "spoiled": (
        "SELECT * REPLACE (CASE WHEN inflation_lag_1 > 20 THEN 'Infinity'::DOUBLE ELSE inflation_lag_1 END AS inflation_lag_1) "
        "FROM windowed"
    ),
}


def _spoiled(spark, sf):
    features = timeseries.add_rolling_mean(timeseries.add_lags(spine(spark, sf)))
    lag = F.col("inflation_lag_1")
    return features.withColumn("inflation_lag_1", F.when(lag > 20, float("inf")).otherwise(lag))


@query(
    "validate_features_ok",
    select(
        _KEYS + " ".join(f"{c}:f" for c in _CHECKED),
        f"SELECT * FROM (SELECT *, {_REASON} FROM spoiled) WHERE reason IS NULL",
        O.chain(_SPOILED),
    ),
)
def validate_features_ok(spark, sf):
    ok, _, _ = scoring.validate_features(_spoiled(spark, sf), _CHECKED)
    return ok.select("country_code", "date", *_CHECKED)


@query(
    "validate_features_rejected",
    select(
        _KEYS + "reason:s",
        f"SELECT * FROM (SELECT *, {_REASON} FROM spoiled) WHERE reason IS NOT NULL",
        O.chain(_SPOILED),
    ),
)
def validate_features_rejected(spark, sf):
    _, rejected, _ = scoring.validate_features(_spoiled(spark, sf), _CHECKED)
    return rejected.select("country_code", "date", "reason")


_RUN = (
    "SELECT 'v1.0.0' AS model_version, 'xgboost' AS algorithm, 'inflation_rate_t_plus_1' AS target, "
    "(SELECT count(inflation_rate_t_plus_1) FROM train) AS train_samples, (SELECT count(*) FROM test) AS test_samples, "
    f"(SELECT {len(_TEXT)} + " + " + ".join(f"(count({c}) > 0)::INT" for c in _ALL_NUMERIC)
    + " FROM train WHERE inflation_rate_t_plus_1 IS NOT NULL) AS feature_count"
)
_RUN_COLUMNS = "model_version:s algorithm:s target:s train_samples:i test_samples:i feature_count:i"


@query("training_metadata", select(_RUN_COLUMNS, _RUN, O.chain(_PREPARED)))
def training_metadata(spark, sf):
    parts = timeseries.temporal_split(_features(spark, sf))
    row = scoring.training_metadata(config.default_config(), *parts)
    return row.select("model_version", "algorithm", "target", "train_samples", "test_samples", "feature_count")


def _predictions(spark, sf):
    features = timeseries.add_target(timeseries.add_rolling_mean(timeseries.add_lags(spine(spark, sf))))
    return B.predictions(features)


_PREDICTED = O.chain(O.PREDICTIONS)
_METRICS = {
    "rmse": "sqrt(avg((actual - predicted) ^ 2))",
    "mae": "avg(abs(actual - predicted))",
    "r2": (
        "CASE WHEN var_pop(actual) > 0 THEN 1 - avg((actual - predicted) ^ 2) / var_pop(actual) "
        "WHEN avg((actual - predicted) ^ 2) = 0 THEN 1 ELSE 0 END"
    ),
    "explained_variance": (
        "CASE WHEN var_pop(actual) > 0 THEN 1 - var_pop(actual - predicted) / var_pop(actual) "
        "WHEN var_pop(actual - predicted) = 0 THEN 1 ELSE 0 END"
    ),
}
_MAPE = {"mape": "100 * avg(abs(actual - predicted) / greatest(abs(actual), 1e-8))"}
_SPREAD = {
    "mean_actual": "avg(actual)",
    "std_actual": "stddev_pop(actual)",
    "mean_predicted": "avg(predicted)",
    "std_predicted": "stddev_pop(predicted)",
}


def _aggregates(metrics: dict[str, str], by: str = "") -> str:
    columns = ", ".join(f"{e} AS {n}" for n, e in metrics.items())
    keys = f"{by}, " if by else ""
    return f"SELECT {keys}{columns} FROM predictions" + (f" GROUP BY {by}" if by else "")


def _doubles(metrics: dict[str, str]) -> str:
    return " ".join(f"{n}:f" for n in metrics)


@query("regression_metrics", select(_doubles(_METRICS), _aggregates(_METRICS), _PREDICTED))
def regression_metrics(spark, sf):
    return evaluation.regression_metrics(_predictions(spark, sf))


@query(
    "regression_metrics_by_country",
    select("country_code:s " + _doubles(_METRICS), _aggregates(_METRICS, "country_code"), _PREDICTED),
)
def regression_metrics_by_country(spark, sf):
    return evaluation.regression_metrics(_predictions(spark, sf), by="country_code")


@query("mape", select("country_code:s mape:f", _aggregates(_MAPE, "country_code"), _PREDICTED))
def mape(spark, sf):
    return evaluation.mape(_predictions(spark, sf), by="country_code")


_DIRECTION = {
    **O.PREDICTIONS,
    "moves": (
        "SELECT actual - lag(actual) OVER w AS da, predicted - lag(predicted) OVER w AS dp FROM predictions "
        "WINDOW w AS (PARTITION BY country_code ORDER BY date)"
    ),
}
_ACCURACY = "SELECT avg(CASE WHEN (da > 0) = (dp > 0) THEN 1.0 ELSE 0.0 END) AS directional_accuracy FROM moves WHERE da IS NOT NULL"


@query("directional_accuracy", select("directional_accuracy:f", _ACCURACY, O.chain(_DIRECTION)))
def directional_accuracy(spark, sf):
    return evaluation.directional_accuracy(_predictions(spark, sf))


@query(
    "distribution_stats",
    select("country_code:s " + _doubles(_SPREAD), _aggregates(_SPREAD, "country_code"), _PREDICTED),
)
def distribution_stats(spark, sf):
    return evaluation.distribution_stats(_predictions(spark, sf), by="country_code")


_RESIDUALS = "SELECT *, actual - predicted AS residual FROM predictions"


@query(
    "prediction_residuals", select(_KEYS + "actual:f predicted:f residual:f", _RESIDUALS, _PREDICTED)
)
def prediction_residuals(spark, sf):
    return evaluation.prediction_residuals(_predictions(spark, sf))


@query(
    "residual_histogram",
    select(
        "bin:i low:f high:f count:i",
        "SELECT bin, lo + w * (bin - 1) AS low, lo + w * bin AS high, "
        "(SELECT count(*) FROM r WHERE least(floor((residual - lo) / w), 19) + 1 = bin) AS count "
        "FROM range(1, 21) AS b(bin), ends",
        O.chain(
            {
                **O.PREDICTIONS,
                "r": _RESIDUALS,
                "ends": "SELECT min(residual) AS lo, (max(residual) - min(residual)) / 20 AS w FROM r",
            }
        ),
    ),
)
def residual_histogram(spark, sf):
    return evaluation.residual_histogram(evaluation.prediction_residuals(_predictions(spark, sf)))


@query(
    "prediction_extent",
    select(
        "low:f high:f r2:f",
        "SELECT least(min(actual), min(predicted)) AS low, greatest(max(actual), max(predicted)) AS high, "
        f"{_METRICS['r2']} AS r2 FROM predictions",
        _PREDICTED,
    ),
)
def prediction_extent(spark, sf):
    return evaluation.prediction_extent(_predictions(spark, sf))


@query("forecast_series", select(_KEYS + "actual:f predicted:f", "SELECT * FROM predictions", _PREDICTED))
def forecast_series(spark, sf):
    return evaluation.forecast_series(_predictions(spark, sf))


_EVERYTHING = {**_METRICS, **_MAPE, **_SPREAD}


@query(
    "metrics_report",
    select(
        _doubles(_EVERYTHING) + " directional_accuracy:f model_version:s dataset:s algorithm:s",
        f"SELECT *, 'v1.0.0' AS model_version, 'inflation_forecast' AS dataset, 'xgboost' AS algorithm "
        f"FROM ({_aggregates(_EVERYTHING)}), ({_ACCURACY})",
        O.chain(_DIRECTION),
    ),
)
def metrics_report(spark, sf):
    return evaluation.metrics_report(_predictions(spark, sf), config.default_config(), timestamp=False)


@query(
    "model_info",
    select(
        f"{_RUN_COLUMNS} rmse:f mae:f r2:f mape:f directional_accuracy:f",
        f"SELECT * FROM ({_RUN}), (SELECT rmse, mae, r2, mape FROM ({_aggregates(_EVERYTHING)})), ({_ACCURACY})",
        O.chain(_PREPARED, _DIRECTION),
    ),
)
def model_info(spark, sf):
    cfg = config.default_config()
    metadata = scoring.training_metadata(cfg, *timeseries.temporal_split(_features(spark, sf)))
    return scoring.model_info(metadata, evaluation.metrics_report(_predictions(spark, sf), cfg, timestamp=False))


_BAND = (
    "SELECT country_code, date, predicted, CASE WHEN predicted < 0 THEN 'deflation' WHEN predicted < 3 THEN 'low/moderate' "
    "WHEN predicted < 10 THEN 'high' ELSE 'very high' END AS band FROM predictions"
)


@query("inflation_band", select(_KEYS + "predicted:f band:s", _BAND, _PREDICTED))
def inflation_band(spark, sf):
    return evaluation.inflation_band(_predictions(spark, sf), "predicted").drop("actual")


@query(
    "band_counts",
    select("band:s n:i", f"SELECT band, count(*) AS n FROM ({_BAND}) GROUP BY 1", _PREDICTED),
)
def band_counts(spark, sf):
    return evaluation.band_counts(_predictions(spark, sf), "predicted")


