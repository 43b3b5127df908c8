"""Benchmark decontamination against a plain search."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from panelflow.llm.decontaminate import find_contamination, remove_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = []
    for doc, text in docs:
        have, hit, found = words(text), set(), set()
        for item, body in items:
            want = words(body)
            size = min(window, len(want))
            grams = {tuple(want[p : p + size]) for p in range(len(want) - size + 1)} if size else set()
            for p in range(len(have) - size + 1) if size else ():
                if tuple(have[p : p + size]) in grams:
                    hit.update(range(p, p + size))
                    found.add("null" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(have), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(have)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    vocabulary = ["a", "b", "Ça", "d9", "e", "ü\xa0x"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 13, 14, 40])))) for i in (10, 9, 100, None, 7)]
    items += [(7, items[4][1]), (55, None), (56, ""), (57, "..."), (58, "a a " * 10)]
    docs = []
    for i in range(60):
        body = " ".join(rng.choices(vocabulary + ["zz", "y!"], k=rng.randint(0, 60)))
        docs.append((i, f"{body}, {rng.choice(items)[1] or ''}; {body.upper()}" if i % 2 else body))
    docs += [(90, None), (91, ""), (3, docs[3][1]), (None, docs[5][1]), (92, "zz " * 60_000 + items[2][1]), (93, "a " * 500)]
    return docs, items


@pytest.mark.parametrize("block_chars", [10**6, 40])
def test_against_plain_search(spark, case, block_chars):
    docs, items = case
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"c0": F.lit(1), "matches": F.lit("x"), "n": F.lit(2)})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit(1))
    got = find_contamination(df, bench, block_chars=block_chars)
    rows = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs, items)
    texts, item_texts = dict(docs), {}
    for i, t in items:
        item_texts.setdefault("null" if i is None else str(i), []).append(words(t))
    for r in got.select("text", "matches").collect():  # matches are verbatim and cannot be longer
        have = words(r["text"])
        for m in r["matches"]:
            part = have[m["begin"] : m["begin"] + m["length"]]
            assert any(w[m["item_begin"] : m["item_begin"] + m["length"]] == part for w in item_texts[m["item_id"]])
    assert texts


def test_removal_and_empty_tables(spark, case):
    docs, items = case
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("contaminated", F.lit("mine"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    bad = [r[0] for r in brute(docs, items) if r[5]]
    left = remove_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(d) for d, _ in docs if not (d in bad))
    assert remove_contaminated(df, bench.limit(0)).count() == len(docs)
    assert remove_contaminated(df.limit(0), bench).count() == 0


def test_query_matches_sql(same_as_sql):
    assert same_as_sql("op3_decontamination")["contaminated"].any()
