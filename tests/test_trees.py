"""Boosted trees and forests against plain versions."""

import math
import random

import numpy as np
import pytest
from helpers import column
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from panelflow import config
from panelflow.operators import boosting, models, trees
from panelflow.operators.boosting import BoostedTrees, BoostedTreesModel
from panelflow.session import scratch_path


def sample(n, seed=1):
    rng = random.Random(seed)
    x = [(rng.randrange(12) / 4, rng.gauss(0, 1), float(rng.randrange(3)), 5.0) for _ in range(n)]
    return x, [math.sin(2 * a) + b * b * (c - 1) + rng.gauss(0, 0.1) for a, b, c, _ in x]


def frame(spark, x, y, parts=3):
    rows = [(i, Vectors.dense(a), b) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label"]).repartition(parts)


def in_order(model, df):
    return np.array(column(model.transform(df).orderBy("id"), "prediction"))


def shrunk(g, alpha):
    return math.copysign(max(abs(g) - alpha, 0), g)


def plain_boosting(x, y, rounds, depth, rate, alpha, lam):
    """Every cut between values of every feature, over row lists."""
    base = sum(y) / len(y)
    margin = [base] * len(y)

    def grow(rows, level):
        g, h = sum(margin[r] - y[r] for r in rows), len(rows)
        here = shrunk(g, alpha) ** 2 / (h + lam)
        best = None
        for f in range(len(x[0])) if level < depth else ():
            for cut in sorted({x[r][f] for r in rows}):
                low, high = [r for r in rows if x[r][f] <= cut], [r for r in rows if x[r][f] > cut]
                if not low or not high:
                    continue
                gl = sum(margin[r] - y[r] for r in low)
                gain = shrunk(gl, alpha) ** 2 / (len(low) + lam) + shrunk(g - gl, alpha) ** 2 / (len(high) + lam) - here
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                    best = gain, low, high
        if best is None:
            return {r: -rate * shrunk(g, alpha) / (h + lam) for r in rows}
        return {**grow(best[1], level + 1), **grow(best[2], level + 1)}

    for _ in range(rounds):
        added = grow(range(len(y)), 0)
        margin = [m + added[r] for r, m in enumerate(margin)]
    return np.array(margin)


@pytest.mark.parametrize("alpha, lam, local_rows", [(0.0, 0.0, 1000), (0.1, 1.0, 1000), (0.1, 1.0, 0), (3.0, 5.0, 30)])
def test_boosting_equals_plain_boosting(spark, monkeypatch, alpha, lam, local_rows):
    """Whether all, no or some nodes are finished in one task."""
    monkeypatch.setattr(boosting, "LOCAL_ROWS", local_rows)
    x, y = sample(90)
    df = frame(spark, x, y)
    model = BoostedTrees(rounds=4, maxDepth=3, rate=0.3, rowShare=1.0, columnShare=1.0, alpha=alpha, lam=lam).fit(df)
    assert np.allclose(in_order(model, df), plain_boosting(x, y, 4, 3, 0.3, alpha, lam), atol=1e-6)


def test_trees_do_not_depend_on_partitions_and_fewer_rounds_are_a_prefix(spark):
    x, y = sample(300, 2)
    settings = dict(maxDepth=3, rowShare=1.0, columnShare=0.5)
    one = BoostedTrees(rounds=12, **settings).fit(frame(spark, x, y, 1)).trees()
    many = BoostedTrees(rounds=12, **settings).fit(frame(spark, x, y, 7)).trees()
    assert (one.feature, one.cut, one.starts) == (many.feature, many.cut, many.starts) and np.allclose(one.value, many.value)
    few = BoostedTrees(rounds=3, **settings).fit(frame(spark, x, y, 5)).trees()
    assert few.cut == one.cut[: len(few.cut)] and few.starts == one.starts[:3]
    for start, end in zip(one.starts, [*one.starts[1:], len(one.feature)]):
        assert len({f for f in one.feature[start:end] if f >= 0}) <= 2


def test_small_nodes_in_one_task_do_not_change_trees(spark, monkeypatch):
    df, drawn = frame(spark, *sample(500, 4)), []
    for local_rows in (1000, 60, 0):
        monkeypatch.setattr(boosting, "LOCAL_ROWS", local_rows)
        drawn.append(in_order(BoostedTrees(rounds=2, maxDepth=4, rowShare=1.0).fit(df), df))
    assert np.allclose(drawn[0], drawn[1], rtol=1e-12) and np.allclose(drawn[0], drawn[2], rtol=1e-12)


def test_rows_per_tree_learn_and_save(spark):
    x, y = sample(600, 3)
    df = frame(spark, x, y)
    model = BoostedTrees(rounds=25, maxDepth=4, rate=0.3).fit(df)
    got = in_order(model, df)
    assert np.mean((got - y) ** 2) < 0.2 * np.var(y)
    path = scratch_path(spark, "boosted")
    model.write().save(path)
    assert np.array_equal(in_order(BoostedTreesModel.load(path), df), got)
    weights = model.featureImportances.toArray()
    assert weights[3] == 0 and math.isclose(weights.sum(), 1)


@pytest.mark.parametrize("y", [[7.0] * 20, [1.0]])
def test_constant_or_single_target_is_the_mean(spark, y):
    df = frame(spark, sample(len(y))[0], y)
    assert set(in_order(BoostedTrees(rounds=2).fit(df), df)) == set(y)


def test_no_target_is_an_error_and_odd_values_go_right(spark):
    x, y = sample(40)
    df = frame(spark, x, y)
    with pytest.raises(ValueError, match="target"):
        BoostedTrees(rounds=1).fit(df.withColumn("label", F.lit(None).cast("double")))
    odd = frame(spark, [(math.nan, *a[1:]) if i % 4 else (math.inf, *a[1:]) for i, a in enumerate(x)], y)
    model = BoostedTrees(rounds=2, maxDepth=3).fit(odd)
    assert np.isfinite(in_order(model, odd)).all()


@pytest.fixture(scope="module")
def grown(spark):
    df = frame(spark, *sample(400, 5)).persist()
    return df, RandomForestRegressor(numTrees=6, maxDepth=9, featureSubsetStrategy="all", seed=3).fit(df)


def by_hand(nodes, x, smallest):
    """Mean of the trees, each followed down while its node is large enough."""
    out = []
    for tree in {t for t, _ in nodes}:
        n = nodes[tree, 0]
        while n["feature"] is not None and n["rows"] >= smallest:
            n = nodes[tree, n["left_id"] if x[n["feature"]] <= n["threshold"] else n["right_id"]]
        out.append(n["prediction"])
    return sum(out) / len(out)


@pytest.mark.parametrize("smallest", [2, 3, 25, 10_000])
def test_least_split_equals_stopping_by_hand(spark, grown, smallest):
    df, model = grown
    nodes = {(r["tree"], r["id"]): r for r in trees.node_table(model).collect()}
    cut = trees.with_least_split(model, smallest)
    expected = [by_hand(nodes, x, smallest) for x in column(df.orderBy("id"), "features")]
    assert np.allclose(in_order(cut, df), expected)
    left = trees.node_table(cut).collect()
    assert all(r["rows"] >= smallest for r in left if r["feature"] is not None)
    assert smallest < 3 or len(left) < len(nodes)


def test_first_trees_are_scored_like_the_forest(grown):
    df, model = grown
    staged = np.array(column(trees.staged_by_leaves(model, df, [1, 4, 6]).orderBy("id"), "staged"))
    assert np.allclose(staged[:, 2], in_order(model, df))
    assert np.allclose(staged[:, 0], in_order(model.trees[0], df))
    assert np.allclose(staged[:, 1], np.mean([in_order(t, df) for t in model.trees[:4]], axis=0))


@pytest.fixture
def cfg():
    made = config.default_config()
    made["model"]["hyperparameters"] = {"max_depth": 3}
    made["features"] = {"numeric": ["a", "b"], "text": []}
    made["target"] = "label"
    return made


def test_search_equals_refitting(spark, cfg):
    cfg["model"]["algorithm"] = "xgboost"
    x, y = sample(120, 7)
    rows = spark.createDataFrame([(a[0], a[1], b) for a, b in zip(x, y)], "a DOUBLE, b DOUBLE, label DOUBLE").coalesce(1)
    train, validation = rows.limit(90).persist(), rows.offset(90).persist()
    grid = [{"n_estimators": n, "learning_rate": r} for n in (2, 5) for r in (0.1, 0.5)]
    found = {r["hyperparameters"]: r["rmse"] for r in models.search_hyperparameters(train, validation, grid, cfg).collect()}
    assert len(found) == 4
    for setting in grid:
        alone = models.search_hyperparameters(train, validation, [setting], cfg).first()
        assert math.isclose(found[alone["hyperparameters"]], alone["rmse"], rel_tol=1e-9)


def test_a_least_split_reaches_the_fitted_pipeline(spark, cfg):
    cfg["model"]["algorithm"] = "random_forest"
    cfg["model"]["hyperparameters"] = {"n_estimators": 3, "max_depth": 6, "min_samples_split": 40}
    x, y = sample(200, 9)
    rows = spark.createDataFrame([(a[0], a[1], b) for a, b in zip(x, y)], "a DOUBLE, b DOUBLE, label DOUBLE")
    nodes = trees.node_table(models.train_model(rows, cfg).stages[-1]).filter("feature IS NOT NULL").collect()
    assert nodes and min(r["rows"] for r in nodes) >= 40
