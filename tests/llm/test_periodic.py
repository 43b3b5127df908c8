"""Periodic runs against plain search."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from panelflow.llm import periodic
from panelflow.llm.queries import QUERIES


def brute(words, repeats=4, least=6):
    """Every start and period by definition."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


repeated = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 8)), max_size=6).map(
    lambda parts: [w for block, times in parts for w in block * times]
)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(repeated, max_size=5), repeats=st.integers(2, 5), least=st.integers(2, 8))
def test_runs_are_those_of_the_definition(texts, repeats, least):
    found = periodic.texts_runs([" ".join(t).encode() for t in texts], repeats, least)
    for words, (n, runs, text) in zip(texts, found):
        want = brute(words, repeats, least)
        assert n == len(words) and runs == want and text.decode() == collapsed(words, want)


@pytest.mark.parametrize("block,stride", [(1, 1), (7, 2)])
def test_small_blocks_change_nothing(monkeypatch, block, stride):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 3, 200).tolist() + list(range(5)) * 9 + [7] * 30 for _ in range(5)]
    want = [brute(t) for t in texts]
    monkeypatch.setattr(periodic, "BLOCK", block)
    monkeypatch.setattr(periodic, "STRIDE", stride)
    assert [sorted(periodic.scan_lags(np.array(t), 4, 6), key=lambda r: (r[0], r[2])) for t in texts] == want


def test_rare_words_split_until_nothing_changes():
    # d is frequent in all, but not in any part between the rare words r and s.
    words = "d d a a a a a a r d d b b b b b b s".split()
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    parts = periodic.surviving_segments(np.array([number[w] for w in words]), np.zeros(len(words), dtype=int), 4, 6)
    assert sorted(p.tolist() for p in parts) == [list(range(2, 8)), list(range(11, 17))]


def test_long_texts():
    n = 200_000
    ((_, runs, text),) = periodic.texts_runs([b"x " * n], 4, 6)
    assert runs == [(0, n, 1)] and text == b"x"
    ((_, runs, _),) = periodic.texts_runs([b" ".join(b"w%d" % (i // 6) for i in range(n))], 4, 6)
    assert len(runs) == -(-n // 6) - (n % 6 > 0) and all(r[1:] == (6, 1) for r in runs)
    rng = np.random.default_rng(0)
    block = [b"v%d" % k for k in rng.integers(0, 50, n // 5)]
    ((_, runs, _),) = periodic.texts_runs([b" ".join(block * 5)], 4, 6)
    assert (0, len(block) * 5, len(block)) in runs


def test_odd_rows(spark):
    rows = [(1, None, 7), (None, "", 7), (2, "a b a b a b a b", 8), (2, "a b a b a b a b", 8), (3, " \t\r\x0b\x0c\n", None), (4, "a a a a a a a", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = periodic.find_periodic_runs(df).collect()
    assert got[0].asDict(recursive=True) == {"doc_id": 1, "n_words": 0, "runs": [], "best": None, "collapsed": ""}
    assert [r.n_words for r in got] == [0, 0, 8, 8, 0, 6]
    assert got[2].best.asDict() == {"start": 0, "length": 8, "period": 2} and got[2].collapsed == "a b" and got[3] == got[2]
    assert got[5].runs == []
    assert periodic.find_periodic_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.find_periodic_runs(df, min_repeats=1)


def planted(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_follows_its_contract(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").filter("length(text) < 4000")
    docs = docs.union(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "x " * 50)], docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    kinds = set()
    for row in docs.collect():
        words, r = planted(row.doc_id, row.text), got.pop(row.doc_id)
        runs = brute(words)
        kinds.add(min(len(runs), 2))
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == digest(collapsed(words, runs))
        best = max(runs, key=lambda v: (v[1] / v[2], -v[0], -v[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
    assert not got and {0, 1} <= kinds
