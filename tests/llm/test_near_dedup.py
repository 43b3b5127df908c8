"""Near duplicates against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from panelflow.llm import near_dedup as N


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(docs, k, percent):
    sets = [shingles(t, k) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for family in range(25):  # copies with a growing number of changed words, around both thresholds
        base = rng.choices(vocabulary, k=rng.choice([30, 80, 200]))
        for copy in range(8):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append((1000 - len(out), " ".join(words)))
    hot = rng.choices(vocabulary, k=120)
    for copy in range(300):  # one large group around a common base
        words = list(hot)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append((5000 + copy, " ".join(words)))
    common = rng.choices(vocabulary, k=12)
    out += [(9000 + i, " ".join(common + rng.choices(vocabulary, k=40))) for i in range(60)]
    out += [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\x0btwo"), (6, "é"), (7, "É"), (6, "é"), (None, "one two"), (None, "alone here now"), (8, "x y " * 40_000)]
    return out


@pytest.mark.parametrize("words,percent,node_rows", [(3, 85, 512), (3, 85, 40), (5, 80, 40)])
def test_against_all_pairs(spark, monkeypatch, docs, words, percent, node_rows):
    monkeypatch.setattr(N, "NODE_ROWS", node_rows)
    monkeypatch.setattr(N, "LOOSE", 30)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"key": F.lit(1), "n": F.lit(1), "comp": F.lit("x")})
    rows = N.near_duplicates(df, words=words, percent=percent).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)
    want = brute(docs, words, percent)
    if node_rows < 512:
        # A dense node that is never settled may lose sets of few links, but links nothing wrongly.
        assert sum(a == b for a, b in zip(got, want)) >= 0.98 * len(want)
        right = {d: c for d, _, c in want}
        assert all(right[d] == right[c] for d, _, c in got if d is not None and c is not None)
        return
    assert got == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    kept = N.keep_first(df, words=words, percent=percent)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _, c in want if d is None or d == c)


def test_salted_join_and_empty(spark, monkeypatch, docs):
    df = spark.createDataFrame(docs[-90:], "doc_id long, text string")
    assert N.near_duplicates(df.limit(0)).count() == 0
    monkeypatch.setattr(N, "broadcast_if_small", lambda df, *a: df)
    got = N.near_duplicates(df, words=3, percent=85).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(docs[-90:], 3, 85)


def test_keep_first_tells_texts_of_one_id_apart(spark):
    text = " ".join(f"w{i}" for i in range(200))
    near, other = text + " more", " ".join(f"o{i}" for i in range(50))
    rows = [(1, text, 7), (2, near, 8), (2, other, 9), (3, "another text of six words", 1), (None, near, 2), (4, None, 3), (4, "", 4), (5, near, 5), (5, text, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone long")
    kept = N.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["_gone"] for r in kept.collect()) == [1, 2, 3, 4, 7, 9]
    # Two texts of the smallest id in one group: one of them stays.
    both = spark.createDataFrame([(1, text), (1, near), (2, text)], "doc_id long, text string")
    assert [r["doc_id"] for r in N.keep_first(both).collect()] == [1]


def test_components(spark):
    edges = [(f"v{i:03}", f"v{i + 1:03}") for i in range(0, 60)] + [("z1", "z2"), ("z2", "z1"), ("q", "q"), ("z3", "z2")]
    got = {r["key"]: r["comp"] for r in N.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {f"v{i:03}": "v000" for i in range(61)} | {"z1": "z1", "z2": "z1", "z3": "z1"}


def test_star_of_over_a_thousand_copies(spark):
    """Copies that link to their base and hardly to each other, in nodes that never get small."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(400)]
    docs = [(0, " ".join(base))]
    for copy in range(1, 1201):
        words = list(base)
        for at in rng.sample(range(400), 9):
            words[at] = f"c{copy}x{at}"
        docs.append((copy, " ".join(words)))
    want = brute(docs, 3, 85)
    assert sum(c == 0 for _, _, c in want) > 1_000
    rows = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str) == want


def test_links_go_into_components_once(spark, monkeypatch, docs):
    """Neither a later tree nor the end of a tree connects again what is connected already."""
    seen, inner = [], N.components

    def components(links):
        seen.extend({(bytes(min(r)), bytes(max(r))) for r in links.select("a", "b").collect()})
        return inner(links)

    monkeypatch.setattr(N, "NODE_ROWS", 40)
    monkeypatch.setattr(N, "components", components)
    assert N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=3, percent=85).count() == len(docs)
    assert len(seen) > 100 and len(set(seen)) == len(seen)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_components_by_either_join(spark, monkeypatch, limit):
    monkeypatch.setattr(N, "BROADCAST_ROW_LIMIT", limit)
    rng = random.Random(3)
    edges = [(f"v{rng.randrange(300):03}", f"v{rng.randrange(300):03}") for _ in range(240)] + [("v000", f"v{i:03}") for i in range(290, 300)]
    up = {v: v for e in edges for v in e}

    def root(v):
        return v if up[v] == v else root(up[v])

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    got = {r["key"]: r["comp"] for r in N.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {v: root(v) for e in edges if e[0] != e[1] for v in e}


def test_components_of_components(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "key string, comp string")

    first = frame([("a", "a"), ("b", "a"), ("d", "c"), ("c", "c")])
    then = frame([("c", "a"), ("a", "a"), ("f", "e"), ("e", "e")])
    assert N._with_joined(None, first) is first
    got = {r["key"]: r["comp"] for r in N._with_joined(first, then).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "e"}
    assert N._with_joined(first, then).count() == 6


def test_a_set_is_one_row_however_many_pivots_it_meets(spark):
    rng = random.Random(5)
    sketch = bytes(rng.randrange(256) for _ in range(4 * N.COORDINATES))
    sets = [(7, 300, bytes([0, i]), bytes([0, i]), sketch) for i in range(200)] + [(7, 300, bytes([1, i]), b"x", bytes(4 * N.COORDINATES)) for i in range(100)]
    rows = spark.createDataFrame(sets, "node long, all long, key binary, comp binary, sketch binary")
    found = N._near_pivots(rows, rows.filter("key < X'0008'"), 0.7).collect()
    assert sorted(bytes(r["key"]) for r in found) == [bytes([0, i]) for i in range(200)]
    for r in found:
        own = bytes(r["key"])
        assert sorted((bytes(p["p_key"]), bytes(p["p_comp"])) for p in r["pivots"]) == [(bytes([0, k]),) * 2 for k in range(8) if bytes([0, k]) != own]


def test_few_sets_are_held_at_once(spark, monkeypatch, docs):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, inner = spark.conf.get(name), set(), N.materialize
    monkeypatch.setattr(N, "TEXT_ROWS", 13)
    monkeypatch.setattr(N, "materialize", lambda df: (seen.add(spark.conf.get(name)), inner(df))[1])
    df = spark.createDataFrame(docs[-90:], "doc_id long, text string")
    rows = N.near_duplicates(df, words=3, percent=85)
    assert "13" in seen and spark.conf.get(name) == before
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows.collect()), key=str) == brute(docs[-90:], 3, 85)
