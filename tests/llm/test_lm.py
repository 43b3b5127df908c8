"""Language-model scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelflow.llm import lm_model as M, lm_score
from panelflow.llm.lm_score import score_texts
from panelflow.llm.queries import QUERIES

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tiny():
    rng = np.random.default_rng(0)
    n = 60
    counts = rng.integers(0, 9, (n + 1, n)).astype(float)
    params = {k: v.astype(np.float64) for k, v in M.begin(n + 1).items()}
    params["out"] = rng.normal(0, 0.3, params["out"].shape)
    return rng, n, params, M.pair_tables(counts, counts.sum(axis=0))


def test_gradients(tiny):
    rng, n, params, pairs = tiny
    previous = rng.integers(0, n + 1, (3, M.WINDOW))
    wanted = pairs.classes[rng.integers(0, n, previous.shape)]
    scored = rng.random(previous.shape) < 0.8
    _, grads = M.gradients(params, previous, wanted, scored, pairs)
    for name, value in params.items():
        at = (int(previous[0, 3]), 2) if name == "id" else tuple(int(rng.integers(0, d)) for d in value.shape)
        sides = []
        for move in (1e-5, -1e-5):
            moved = {k: v.copy() for k, v in params.items()}
            moved[name][at] += move
            sides.append(M.gradients(moved, previous, wanted, scored, pairs)[0])
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-3, abs=1e-7)


def test_each_place_is_scored_once_without_looking_ahead(tiny):
    rng, n, params, pairs = tiny
    texts = [rng.integers(0, n, k) for k in (0, 1, M.WINDOW, M.WINDOW + 1, 500, 3)]
    many, owner, previous, wanted, scored = M.text_windows(texts, n)
    shares = [M.text_windows(texts, n, 3, seen)[2] for seen in range(3)]
    assert many == len(owner) == sum(map(len, shares))
    assert np.array_equal(shares[0], previous[::3]) and np.array_equal(shares[1], previous[2::3])
    for i, t in enumerate(texts):
        assert wanted[owner == i][scored[owner == i]].tolist() == t.tolist()
        assert previous[owner == i][scored[owner == i]].tolist() == [n, *t.tolist()[:-1]][: len(t)]
    z, logsum, _ = M.class_scores(params, previous, pairs)
    changed = previous.copy()
    changed[:, 20:] = 0
    again = M.class_scores(params, changed, pairs)[0]
    shape = (*previous.shape, -1)
    assert np.allclose(z.reshape(shape)[:, :20], again.reshape(shape)[:, :20])
    # A distribution: probabilities of all ids at a place sum to one.
    p = np.exp(z[5] - logsum[5])[pairs.classes] * np.exp(pairs.log_id[previous.ravel()[5]] - pairs.log_class[previous.ravel()[5], pairs.classes])
    assert p.sum() == pytest.approx(1, abs=1e-4)


def base(docs):
    words = [re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for _, t in docs]
    out = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs]
    counts = Counter(w for ws, o in zip(words, out) if not o for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    log = lambda w: math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1)))
    return [(d, o, len(ws) + 1, sum(counts[w] > 0 for w in [*ws, None]), n, sum(map(log, [*ws, None]))) for (d, _), ws, o in zip(docs, words, out)]


@pytest.mark.parametrize("held", [200_000, 3])
def test_base_scores(spark, monkeypatch, held):
    monkeypatch.setattr(lm_score, "HELD_WORDS", held)
    monkeypatch.setattr(lm_score, "DISTINCT_BEFORE_FLUSH", 5)
    docs = [(i, f"The the cat {i % 5} É\xa0x sat{i}\x0bon " * (i % 4)) for i in range(40)]
    docs += [(50, None), (51, ""), (3, docs[3][1]), (3, "other text"), (None, "no id"), (None, None), (60, "long " * 30_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"id": F.lit(1), "score": F.lit("x"), "word": F.lit(2)})
    rows = score_texts(df, WORD, 49407).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows), key=str)
    assert got == sorted(((*b[:5], round(b[5], 6)) for b in base(docs)), key=str)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert score_texts(df.limit(0), WORD, 49407).count() == 0


def test_model_beats_words_on_held_out_texts(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    rows = QUERIES["op6_lm_score"](spark, sf).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {b[0]: b for b in base(docs)}
    for r in rows:
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][5], abs=1e-6)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_every_training_window_is_trained_on(spark):
    docs = [(i, " ".join(f"w{(i * j) % 97}" for j in range(40 * i))) for i in range(30)]
    frame = spark.createDataFrame(docs, "id long, text string").withColumn("held_out", F.lit(False))
    tokens = lm_score.subword_ids(frame, WORD, 49407).repartition(3)
    texts = [t % 50 for b in [pa.table(tokens.toPandas()[["ids", "width"]]).to_batches()[0]] for t in lm_score._unpacked(b)]
    counts = np.ones((51, 50))
    params = M.begin(51)
    listed = np.arange(50_000) % 50
    trained, used = lm_score._train_round(tokens, params, M.pair_tables(counts, counts.sum(axis=0)), listed, 50)
    assert used == len(M.windows(np.array([len(t) for t in texts]))[0]) > 300
    assert not np.array_equal(trained["out"], params["out"])


@pytest.mark.parametrize("held", [400_000, 40, 0])
def test_every_pair_has_its_own_count(spark, monkeypatch, held):
    """Scores are those by exact pair counts of all ids, held by the tasks or joined, dense or not."""
    monkeypatch.setattr(lm_score, "DENSE_IDS", 20)
    monkeypatch.setattr(lm_score, "HELD_PAIRS", held)
    monkeypatch.setattr(lm_score, "DISTINCT_PAIRS", 50)
    monkeypatch.setattr(lm_score, "PORTION_IDS", 300)
    monkeypatch.setattr(lm_score, "ROUNDS", 0)  # attention begins at the pair counts' classes
    words = ["".join(w) for w in np.random.default_rng(3).choice(list("abcdefghijklmnopqrstuvwxyz"), (97, 6))]
    docs = [(i, " ".join(words[i * j % 97] for j in range(3 * i))) for i in range(40)] + [(50, "unseen words here"), (51, None)]
    frame = spark.createDataFrame(docs, "id long, text string").withColumn("held_out", F.col("id") % 10 == 0)
    got = {r["id"]: r["score"] for r in lm_score.model_scores(frame, WORD, 49407).collect()}
    rows = lm_score.subword_ids(frame, WORD, 49407).toPandas()
    texts = dict(zip(rows["id"], lm_score._unpacked(pa.RecordBatch.from_pandas(rows))))
    before = {i: [-1, *t[:-1].tolist()] for i, t in texts.items()}
    size = lm_score.encoder(WORD).tokenizer.get_vocab_size()
    trained = [i for i in texts if i % 10]
    ids = Counter(x for i in trained for x in texts[i].tolist())
    pairs = Counter(p for i in trained for p in zip(before[i], texts[i].tolist()))
    firsts = Counter(p for i in trained for p in before[i])
    total = sum(ids.values()) + 0.1 * size
    share = lambda x: M.SMOOTHING * (ids[x] + 0.1) / total
    want = {i: sum(math.log10((pairs[p, x] + share(x)) / (firsts[p] + M.SMOOTHING)) for p, x in zip(before[i], t.tolist())) for i, t in texts.items()}
    assert len(ids) > 60 and got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i], rel=1e-4)
