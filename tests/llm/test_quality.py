"""Quality classifier."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from panelflow.llm import quality as Q
from panelflow.llm.queries import QUERIES


def test_trees_against_plain_traversal():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    forest = Q.fit(x[:2000], y[:2000])
    got = forest.scores(x)

    def walk(row):
        total = forest.base
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            k = 0
            while k < len(f):
                k = 2 * k + (2 if row[f[k]] > t[k] else 1)
            total += leaf[k - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(got[:200], [walk(r) for r in x[:200]])
    assert ((got[2000:] >= 0.5) == y[2000:]).mean() > 0.95


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    rows = QUERIES["op5_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.97


def test_odd_rows(spark):
    docs = [(i, "word " * (i % 7) + ("!" * i)) for i in range(200)] + [(None, None), (500, ""), (500, ""), (501, "x" * 400_000), (502, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("s"), "c0": F.lit(1), "_y": F.lit(0)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(None, 1), (3, None), (4, 7), (500, 1)], "doc_id long, quality int")
    got = Q.score_quality(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert {r["score"] for r in Q.score_quality(df, labels.limit(0)).collect()} == {0.5}
    assert Q.score_quality(df.limit(0), labels).count() == 0
    kept = Q.keep_good(df, labels)
    assert kept.columns == df.columns
    good = sorted(str(r["doc_id"]) for r in got if r["score"] >= 0.5)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == good
