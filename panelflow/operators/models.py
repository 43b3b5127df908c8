"""Training: forest and boosted trees behind the preprocessor, and grid search."""

from __future__ import annotations

import json
from collections.abc import Iterable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from panelflow import config
from panelflow.operators import trees
from panelflow.operators.boosting import BoostedTrees, BoostedTreesModel
from panelflow.operators.preprocess import PanelPreprocessor

DEFAULT_TREES = 100
DEEPEST = 30  # the deepest tree MLlib grows


def _columns(cfg: dict) -> dict:
    return {"featuresCol": "features", "labelCol": cfg["target"], "predictionCol": "prediction"}


def random_forest(cfg: dict) -> RandomForestRegressor:
    """All features compete at each split; children have at least ``min_samples_leaf`` rows.

    ``min_samples_split`` is applied to the fitted trees, see ``fit_regressor``.
    """
    h = cfg["model"].get("hyperparameters", {})
    return RandomForestRegressor(
        numTrees=h.get("n_estimators", 200),
        maxDepth=min(h.get("max_depth", 10), DEEPEST),
        minInstancesPerNode=h.get("min_samples_leaf", 1),
        featureSubsetStrategy="all",
        seed=cfg["model"].get("random_state", 42),
        **_columns(cfg),
    )


def boosted_trees(cfg: dict) -> BoostedTrees:
    """Gradient boosting with squared loss, L1 and L2 leaf penalties, rows and columns per tree."""
    h = cfg["model"].get("hyperparameters", {})
    return BoostedTrees(
        rounds=h.get("n_estimators", 200),
        maxDepth=h.get("max_depth", 6),
        rate=float(h.get("learning_rate", 0.1)),
        rowShare=float(h.get("subsample", 0.8)),
        columnShare=float(h.get("colsample_bytree", 0.8)),
        alpha=float(h.get("reg_alpha", 0.1)),
        lam=float(h.get("reg_lambda", 1.0)),
        seed=cfg["model"].get("random_state", 42),
        **_columns(cfg),
    )


def default_forest(cfg: dict) -> RandomForestRegressor:
    """For unknown algorithm names.  ``max_depth`` caps the depth for large tables."""
    depth = cfg["model"].get("hyperparameters", {}).get("max_depth", DEEPEST)
    return RandomForestRegressor(
        numTrees=DEFAULT_TREES,
        maxDepth=min(depth, DEEPEST),
        featureSubsetStrategy="all",
        seed=cfg["model"].get("random_state", 42),
        **_columns(cfg),
    )


def build_regressor(cfg: dict) -> Estimator:
    builders = {"xgboost": boosted_trees, "random_forest": random_forest}
    return builders.get(cfg["model"].get("algorithm"), default_forest)(cfg)


def fit_regressor(cfg: dict, prepared: DataFrame) -> Model:
    """The configured regressor fitted on prepared rows.

    Of a configured forest, nodes of fewer than ``min_samples_split`` rows become leaves.
    """
    model = build_regressor(cfg).fit(prepared)
    if cfg["model"].get("algorithm") == "random_forest":
        model = trees.with_least_split(model, cfg["model"].get("hyperparameters", {}).get("min_samples_split", 2))
    return model


def _labelled(df: DataFrame, cfg: dict) -> DataFrame:
    """Configured features that the table has, and the target, of rows that have a target."""
    features = [c for c in [*cfg["features"]["numeric"], *cfg["features"]["text"]] if c in df.columns]
    return df.select(*features, cfg["target"]).filter(F.col(cfg["target"]).isNotNull())


def train_model(train: DataFrame, cfg: dict | None = None, exact: bool = True) -> PipelineModel:
    """Fit preprocessor and regressor on the rows that have a target.

    The rows are cached while the trees are grown; a lost executor only recomputes its
    part of them.
    """
    cfg = cfg or config.default_config()
    rows = _labelled(train, cfg).persist()
    try:
        prepared = PanelPreprocessor.from_config(rows, cfg, exact).fit(rows)
        return PipelineModel([prepared, fit_regressor(cfg, prepared.transform(rows))])
    finally:
        rows.unpersist()


def _with_algorithm(cfg: dict | None, algorithm: str) -> dict:
    cfg = cfg or config.default_config()
    return {**cfg, "model": {**cfg["model"], "algorithm": algorithm}}


def train_random_forest(train: DataFrame, cfg: dict | None = None) -> PipelineModel:
    return train_model(train, _with_algorithm(cfg, "random_forest"))


def train_gbt(train: DataFrame, cfg: dict | None = None) -> PipelineModel:
    return train_model(train, _with_algorithm(cfg, "xgboost"))


def train_default(train: DataFrame, cfg: dict | None = None) -> PipelineModel:
    return train_model(train, _with_algorithm(cfg, "default"))


def search_hyperparameters(
    train: DataFrame,
    validation: DataFrame,
    grid: Iterable[dict],
    cfg: dict | None = None,
    parallelism: int = 2,
    exact: bool = True,
) -> DataFrame:
    """``(hyperparameters, rmse)`` per setting, best first.

    Time is respected: every setting is fitted on the training months and scored on the
    fixed validation months.  Settings share one fit of the preprocessor and one copy of the
    prepared rows.  Settings that differ in ``n_estimators`` alone share one ensemble: the one of the
    most trees is grown and its first trees are scored.  Of boosted trees those are just the
    trees that fewer rounds would grow; of a forest they are as good a draw of a smaller forest.
    """
    cfg = cfg or config.default_config()
    target = cfg["target"]
    rows = _labelled(train, cfg)
    prepared = PanelPreprocessor.from_config(rows, cfg, exact).fit(rows)
    fitted, scored_on = (prepared.transform(x).select("features", target).persist() for x in (rows, _labelled(validation, cfg)))
    shared: dict[str, list[tuple[int, dict]]] = {}
    for setting in grid:
        merged = {**cfg["model"].get("hyperparameters", {}), **setting}
        size = merged.pop("n_estimators", 200)
        if cfg["model"].get("algorithm") not in ("xgboost", "random_forest"):
            size = DEFAULT_TREES  # the default forest has no setting for it
        shared.setdefault(json.dumps(merged, sort_keys=True), []).append((size, setting))

    def score(settings: tuple[str, list[tuple[int, dict]]]) -> list[tuple[str, float]]:
        sizes = [size for size, _ in settings[1]]
        merged = {**json.loads(settings[0]), "n_estimators": max(sizes)}
        model = fit_regressor({**cfg, "model": {**cfg["model"], "hyperparameters": merged}}, fitted)
        if isinstance(model, BoostedTreesModel):
            staged = model.staged(scored_on, sizes)
        else:
            staged = trees.staged_by_leaves(model, scored_on, sizes)
        errors = staged.agg(*trees.squared_error(target, F.col("staged"), sizes)).first()
        return [(json.dumps(setting, sort_keys=True), e) for (_, setting), e in zip(settings[1], errors)]

    try:
        with ThreadPool(parallelism) as pool:
            scored = [s for several in pool.map(score, shared.items()) for s in several]
    finally:
        fitted.unpersist()
        scored_on.unpersist()
    return train.sparkSession.createDataFrame(
        scored, "hyperparameters STRING, rmse DOUBLE"
    ).orderBy("rmse", "hyperparameters")
