"""Gradient boosting with second-order leaf weights, L1 and L2 penalties and columns per tree.

A tree grows level by level.  Each task sums the gradients of its rows by (node, feature, bin)
in numpy; Spark adds the tasks' histograms up and finds each feature's best cut by a window over
bins.  The driver sees one row per node and feature, whatever the number of rows.  Nodes of at most
``LOCAL_ROWS`` rows are finished below by one task each, by the same sums and rules.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from panelflow.session import materialize, numbered

EDGES = 255  # cuts tried per feature
LOCAL_ROWS = 50_000  # a node of so few rows is finished in one task
REWRITE = 10  # trees after which predictions so far are written to the rows
# Gradients are added up as whole numbers of this share of the largest: sums are exact in any
# order, and 2^33 rows of the largest gradient fit a long.
STEPS = 2.0**29
LEAST_GAIN = 1e-6  # rounding: a smaller gain is none
_CELL = "node INT, feature INT, bin INT, g LONG, h LONG"


class Trees:
    """Nodes of one or more trees in flat lists; a leaf has feature -1."""

    def __init__(self, starts=(), feature=(), cut=(), left=(), right=(), value=(), gain=()):
        self.starts, self.feature, self.cut = list(starts), list(feature), list(cut)
        self.left, self.right, self.value, self.gain = list(left), list(right), list(value), list(gain)

    def begin(self) -> int:
        self.starts.append(len(self.feature))
        return self._leaf(0.0)

    def _leaf(self, value: float) -> int:
        self.feature.append(-1)
        self.cut.append(0)
        self.left.append(-1)
        self.right.append(-1)
        self.value.append(value)
        self.gain.append(0.0)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = self._leaf(values[0]), self._leaf(values[1])
        return self.left[node], self.right[node]

    def graft(self, node: int, below) -> None:
        """Puts a subtree, whose first node is its root, in place of a leaf."""
        shift = len(self.feature) - 1  # of the nodes after the root
        moved = [[c + shift if c > 0 else -1 for c in below[side]] for side in ("left", "right")]
        lists = (below["feature"], below["cut"], *moved, below["value"], below["gain"])
        for mine, theirs in zip((self.feature, self.cut, self.left, self.right, self.value, self.gain), lists):
            mine[node] = theirs[0]
            mine.extend(theirs[1:])

    def reached(self, x: np.ndarray, start: int) -> np.ndarray:
        """Leaf of the tree at ``start`` per row; a value that is not at most the cut goes right."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        at, rows = np.full(len(x), start), np.arange(len(x))
        while True:
            f = feature[at]
            if (f < 0).all():
                return at
            goes_left = x[rows, np.maximum(f, 0)] <= cut[at]
            at = np.where(f < 0, at, np.where(goes_left, left[at], right[at]))

    def added(self, x: np.ndarray, trees: Sequence[int] | None = None) -> np.ndarray:
        """Sum of the trees' values per row."""
        value, total = np.array(self.value), np.zeros(len(x))
        for start in self.starts if trees is None else trees:
            total += value[self.reached(x, start)]
        return total


def _share(rows: np.ndarray, seed: int) -> np.ndarray:
    """A number from 0 to 1 per row number and seed (mixing constants of a 64-bit finalizer)."""
    z = rows.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))).astype(np.float64) / 2.0**64


def _arrays(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
    row, y, margin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_row", "y", "margin"))
    return bins, row, y, margin


def feature_edges(df: DataFrame, features: int) -> list[list[float]]:
    """Up to ``EDGES`` values per feature of the array ``x``: all of few values, else quantiles.

    The sketches of all features are made in one pass and merged.
    """
    shares = [(i + 1) / EDGES for i in range(EDGES)]
    found = df.agg(*[F.percentile_approx(F.col("x")[i], shares, 10_000).alias(f"e{i}") for i in range(features)]).first()
    return [sorted({e for e in found[i] or [] if e == e}) for i in range(features)]


def _binned(df: DataFrame, edges: list[list[float]]) -> DataFrame:
    """Rows as one byte per feature: the number of edges below its value."""

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack(b["x"].to_numpy()) if len(b) else np.zeros((0, len(edges)))
            out = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1).astype(np.uint8)
            yield pd.DataFrame({"_row": b["_row"], "y": b["y"], "margin": b["margin"], "bins": [r.tobytes() for r in out]})

    return df.mapInPandas(bins, "_row LONG, y DOUBLE, margin DOUBLE, bins BINARY")


def _with_trees(table: DataFrame, trees: Trees, done: Sequence[int], features: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, _, _, margin = _arrays(b, features)
            yield b.set_column(b.schema.get_field_index("margin"), "margin", pa.array(margin + trees.added(bins, done)))

    return table.mapInArrow(add, table.schema)


def _gradients(batch: pa.RecordBatch, trees: Trees, done, start, wanted, features, scale, keep, seed) -> tuple[np.ndarray, ...]:
    """Node, bins and whole-number gradient of the drawn rows in the ``wanted`` nodes."""
    place = np.full(len(trees.feature), -1)
    place[wanted] = wanted
    bins, row, y, margin = _arrays(batch, features)
    at = place[trees.reached(bins, start)]
    used = (at >= 0) & (_share(row, seed) < keep)
    error = margin[used] + trees.added(bins[used], done) - y[used]
    return at[used], bins[used], np.rint(error * scale).astype(np.int64)


def _histograms(table, trees, done, start, frontier, columns, features, scale, keep, seed) -> DataFrame:
    """Sums of gradients and row counts by node, feature and bin, one set of rows per task."""
    place = np.full(len(trees.feature), -1)
    place[frontier] = np.arange(len(frontier))
    shape = len(frontier), len(columns), EDGES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g_sum, h_sum = (np.zeros(int(np.prod(shape)), np.int64) for _ in range(2))
        for b in batches:
            at, bins, g = _gradients(b, trees, done, start, frontier, features, scale, keep, seed)
            for i, c in enumerate(columns):
                cell = (place[at] * len(columns) + i) * shape[2] + bins[:, c]
                np.add.at(g_sum, cell, g)
                h_sum += np.bincount(cell, minlength=len(h_sum))
        cells = np.flatnonzero(h_sum)
        node, feature, low = np.unravel_index(cells, shape)
        out = [np.array(frontier)[node].astype(np.int32), np.array(columns)[feature].astype(np.int32), low.astype(np.int32), g_sum[cells], h_sum[cells]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=["node", "feature", "bin", "g", "h"])

    return table.mapInArrow(sums, _CELL)


def best_cut(bins: np.ndarray, g: np.ndarray, columns: Sequence[int], scale: float, alpha: float, lam: float, least: int) -> tuple | None:
    """``(gain, feature, bin)`` of the best cut of one node's rows, ties to the first feature, then bin."""

    def score(gs, hs):
        shrunk = np.maximum(np.abs(gs / scale) - alpha, 0.0)
        return shrunk * shrunk / (hs + lam)

    best = None
    for c in columns:
        # Sums of at most LOCAL_ROWS whole numbers near 2^29 are exact as doubles.
        gl = np.bincount(bins[:, c], g, EDGES + 1).cumsum()
        hl = np.bincount(bins[:, c], minlength=EDGES + 1).cumsum()
        allowed = (hl >= least) & (hl[-1] - hl >= least)
        if not allowed.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = score(gl, hl) + score(gl[-1] - gl, hl[-1] - hl) - score(gl[-1], hl[-1])
        at = int(np.argmax(np.where(allowed, gain, -np.inf)))
        if gain[at] > LEAST_GAIN and (best is None or gain[at] > best[0]):
            best = float(gain[at]), int(c), at
    return best


def _subtrees(table, trees, done, start, levels: dict[int, int], columns, features, scale, keep, seed, rate, alpha, lam, least) -> DataFrame:
    """``(node, subtree)``: all levels below small nodes, each node's rows in one task."""
    wanted = list(levels)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, bins, g = _gradients(b, trees, done, start, wanted, features, scale, keep, seed)
            out = [pa.array(at.astype(np.int32)), pa.array([r.tobytes() for r in bins], pa.binary()), pa.array(g)]
            yield pa.RecordBatch.from_arrays(out, names=["node", "bins", "g"])

    def finished(rows: pd.DataFrame) -> pd.DataFrame:
        node = int(rows["node"].iloc[0])
        bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(-1, features)
        g, below = rows["g"].to_numpy(), Trees()
        root = below.begin()
        below.value[root] = rate * _weight(g.sum() / scale, len(g), alpha, lam)
        open_nodes = [(root, np.arange(len(g)), levels[node])]
        while open_nodes:
            at, held, left = open_nodes.pop(0)
            best = best_cut(bins[held], g[held], columns, scale, alpha, lam, least) if left else None
            if best is None:
                continue
            gain, feature, cut = best
            low = bins[held, feature] <= cut
            sides = held[low], held[~low]
            values = tuple(rate * _weight(g[side].sum() / scale, len(side), alpha, lam) for side in sides)
            children = below.split(at, feature, cut, gain, values)
            open_nodes += [(c, side, left - 1) for c, side in zip(children, sides)]
        lists = {c: [getattr(below, c)] for c in ("feature", "cut", "left", "right", "value", "gain")}
        return pd.DataFrame({"node": [node], **lists})

    whole, real = "ARRAY<INT>", "ARRAY<DOUBLE>"
    schema = f"node INT, feature {whole}, cut {whole}, left {whole}, right {whole}, value {real}, gain {real}"
    return table.mapInArrow(drawn, "node INT, bins BINARY, g LONG").groupBy("node").applyInPandas(finished, schema)


def _score(g: str, h: str) -> str:
    """SQL of a node's score: the square of its shrunk gradient over the penalised count."""
    shrunk = f"greatest(abs(({g}) / :scale) - :alpha, 0D)"
    return f"{shrunk} * {shrunk} / ({h} + :lam)"


# One statement of fixed text, since a fit plans it thousands of times.
_BEST = f"""
    SELECT node, feature, any_value(g) AS g, any_value(h) AS h,
        max(CASE WHEN gain IS NOT NULL THEN named_struct('gain', gain, 'low_bin', -bin, 'gl', gl, 'hl', hl) END) AS best
    FROM (
        SELECT *, CASE WHEN hl >= :least AND h - hl >= :least
            THEN {_score("gl", "hl")} + {_score("g - gl", "h - hl")} - {_score("g", "h")} END AS gain
        FROM (
            SELECT node, feature, bin, sum(sg) OVER (PARTITION BY node, feature ORDER BY bin) AS gl, sum(sh) OVER (PARTITION BY node, feature ORDER BY bin) AS hl,
                sum(sg) OVER (PARTITION BY node, feature) AS g, sum(sh) OVER (PARTITION BY node, feature) AS h
            FROM (SELECT node, feature, bin, sum(g) AS sg, sum(h) AS sh FROM {{cells}} GROUP BY node, feature, bin)
        )
    )
    GROUP BY node, feature
"""


def best_cuts(cells: DataFrame, scale: float, alpha: float, lam: float, least_rows: int) -> DataFrame:
    """The best cut of each node and feature, ties to the smaller bin; ``best`` is null if there is none.

    ``(node, feature, g, h, best: (gain, low_bin, gl, hl))``; tasks have summed their rows already,
    so cells are dealt by node and feature once and added up there.
    """
    values = {"scale": scale, "alpha": alpha, "lam": lam, "least": least_rows}
    return cells.sparkSession.sql(_BEST, values, cells=cells.repartition("node", "feature"))


def _weight(g: float, h: float, alpha: float, lam: float) -> float:
    return -float(np.sign(g) * max(abs(g) - alpha, 0.0)) / (h + lam)


class _BoostingParams(Params):
    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels below the root", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a leaf's weight that is added", TypeConverters.toFloat)
    rowShare = Param(Params._dummy(), "rowShare", "rows per tree", TypeConverters.toFloat)
    columnShare = Param(Params._dummy(), "columnShare", "features per tree", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "L1 penalty", TypeConverters.toFloat)
    lam = Param(Params._dummy(), "lam", "L2 penalty", TypeConverters.toFloat)
    leastRows = Param(Params._dummy(), "leastRows", "rows in a child", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "target", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)


_DEFAULTS = dict(
    rounds=200, maxDepth=6, rate=0.1, rowShare=0.8, columnShare=0.8, alpha=0.1, lam=1.0, leastRows=1,
    seed=42, featuresCol="features", labelCol="label", predictionCol="prediction",
)


class BoostedTrees(_BoostingParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Squared loss; the first prediction is the mean.  Rows are drawn per tree by a hash of
    their number, columns per tree by seed and tree; the first trees of more rounds are the trees of fewer."""

    @keyword_only
    def __init__(
        self, *, rounds=200, maxDepth=6, rate=0.1, rowShare=0.8, columnShare=0.8, alpha=0.1, lam=1.0,
        leastRows=1, seed=42, featuresCol="features", labelCol="label", predictionCol="prediction",
    ):
        super().__init__()
        self._setDefault(**_DEFAULTS)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        get = self.getOrDefault
        alpha, lam, rate = get("alpha"), get("lam"), get("rate")
        rows = df.select(vector_to_array(get("featuresCol")).alias("x"), F.col(get("labelCol")).cast("double").alias("y"))
        rows = numbered(rows.filter("y IS NOT NULL AND NOT isnan(y)"))
        about = rows.agg(F.avg("y").alias("mean"), F.max("y").alias("high"), F.min("y").alias("low"), F.max(F.size("x")).alias("n"), F.count("y").alias("rows")).first()
        if about["n"] is None:
            raise ValueError("no row has a target")
        features, base = about["n"], about["mean"]
        spread = about["high"] - about["low"]
        if not np.isfinite(spread):
            raise ValueError("the target is not finite")
        scale = STEPS / spread if spread else 1.0
        edges = feature_edges(rows, features)
        table = materialize(_binned(rows.withColumn("margin", F.lit(base)), edges)).persist()
        trees, done = Trees(), []
        try:
            for t in range(get("rounds")):
                chosen = max(1, int(get("columnShare") * features))
                columns = sorted(random.Random(f"{get('seed')} {t}").sample(range(features), chosen))
                start = trees.begin()
                drawing = columns, features, scale, get("rowShare"), get("seed") * 1_000_003 + t
                frontier, small = ([], {start: get("maxDepth")}) if about["rows"] <= LOCAL_ROWS else ([start], {})
                for level in range(get("maxDepth")):
                    if not frontier:
                        break
                    cells = _histograms(table, trees, done, start, frontier, *drawing)
                    found = best_cuts(cells, scale, alpha, lam, get("leastRows")).collect()
                    grown = self._grown(trees, start, found, scale)
                    frontier = [c for c, n in grown if n > LOCAL_ROWS]
                    small.update({c: get("maxDepth") - level - 1 for c, n in grown if n <= LOCAL_ROWS})
                small = {c: levels for c, levels in small.items() if levels or c == start}
                if small:
                    below = _subtrees(table, trees, done, start, small, *drawing, rate, alpha, lam, get("leastRows"))
                    for r in sorted(below.collect(), key=lambda r: r["node"]):
                        trees.graft(r["node"], r)
                done.append(start)
                if len(done) == REWRITE and t + 1 < get("rounds"):
                    before, table = table, materialize(_with_trees(table, trees, done, features)).persist()
                    before.unpersist()
                    done = []
        finally:
            table.unpersist()
        cuts = [edges[f][c] if f >= 0 else 0.0 for f, c in zip(trees.feature, trees.cut)]
        return BoostedTreesModel(
            base=base, features=features, starts=trees.starts, feature=trees.feature, cut=cuts, left=trees.left, right=trees.right,
            value=trees.value, gain=trees.gain, featuresCol=get("featuresCol"), predictionCol=get("predictionCol"),
        )

    def _grown(self, trees: Trees, start: int, found: list, scale: float) -> list[tuple[int, int]]:
        """Splits nodes by the best of their features, ties to the first; the nodes to go on with and their rows."""
        get = self.getOrDefault
        by_node: dict[int, list] = {}
        for r in found:
            by_node.setdefault(r["node"], []).append(r)
        deeper = []
        for node, rows in sorted(by_node.items()):
            g, h = rows[0]["g"] / scale, rows[0]["h"]
            if node == start:
                trees.value[node] = get("rate") * _weight(g, h, get("alpha"), get("lam"))
            rows = [r for r in rows if r["best"] and r["best"]["gain"] > LEAST_GAIN]
            if not rows:
                continue
            r = max(rows, key=lambda r: (r["best"]["gain"], -r["feature"]))
            best = r["best"]
            sides = [(best["gl"], best["hl"]), (r["g"] - best["gl"], h - best["hl"])]
            values = tuple(get("rate") * _weight(a / scale, b, get("alpha"), get("lam")) for a, b in sides)
            children = trees.split(node, r["feature"], -best["low_bin"], best["gain"], values)
            deeper += [(c, n) for c, (_, n) in zip(children, sides) if n >= 2 * get("leastRows")]
        return deeper


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees as flat lists; saved and loaded like any stage."""

    base = Param(Params._dummy(), "base", "first prediction", TypeConverters.toFloat)
    features = Param(Params._dummy(), "features", "length of the vector", TypeConverters.toInt)
    starts = Param(Params._dummy(), "starts", "root per tree", TypeConverters.toListInt)
    feature = Param(Params._dummy(), "feature", "feature per node, -1 in leaves", TypeConverters.toListInt)
    cut = Param(Params._dummy(), "cut", "largest value that goes left", TypeConverters.toListFloat)
    left = Param(Params._dummy(), "left", "left child", TypeConverters.toListInt)
    right = Param(Params._dummy(), "right", "right child", TypeConverters.toListInt)
    value = Param(Params._dummy(), "value", "what a leaf adds", TypeConverters.toListFloat)
    gain = Param(Params._dummy(), "gain", "gain per split", TypeConverters.toListFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, base=0.0, features=0, starts=(), feature=(), cut=(), left=(), right=(), value=(), gain=(),
        featuresCol="features", predictionCol="prediction",
    ):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def trees(self) -> Trees:
        return Trees(*(self.getOrDefault(p) for p in ("starts", "feature", "cut", "left", "right", "value", "gain")))

    @property
    def featureImportances(self) -> DenseVector:
        """Mean gain of a feature's splits, as a share of all features' means."""
        trees, n = self.trees(), self.getOrDefault("features")
        inner = [(f, g) for f, g in zip(trees.feature, trees.gain) if f >= 0]
        where = np.array([f for f, _ in inner], dtype=int)
        count = np.bincount(where, minlength=n)
        mean = np.bincount(where, [g for _, g in inner], n) / np.maximum(count, 1)
        return Vectors.dense(mean / mean.sum() if mean.sum() else mean)

    def staged(self, df: DataFrame, sizes: Sequence[int], name: str = "staged") -> DataFrame:
        """``df`` with an array of the predictions of the first ``sizes[i]`` trees."""
        trees, base = self.trees(), self.getOrDefault("base")

        @F.pandas_udf("array<double>")
        def predictions(vectors: pd.Series) -> pd.Series:
            if vectors.empty:
                return pd.Series([], dtype=object)
            x, total, out, last = np.stack(vectors.to_numpy()), base, {}, 0
            for size in sorted(set(sizes)):
                total = total + trees.added(x, trees.starts[last:size])
                out[size], last = total, size
            return pd.Series(list(np.stack([out[s] for s in sizes], axis=1)))

        return df.withColumn(name, predictions(vector_to_array(self.getOrDefault("featuresCol"))))

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getOrDefault("predictionCol")
        every = [len(self.getOrDefault("starts"))]
        return self.staged(df, every, name).withColumn(name, F.col(name)[0])
