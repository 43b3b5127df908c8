"""Byte-level BPE against the tokenizers library and plain merging."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from panelflow.llm import bpe
from panelflow.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def decoded(ids):
    (text,) = bpe.decoder(PATH).decode(np.array([-1 if i is None else i for i in ids], dtype=np.int32), np.array([len(ids)]))
    return text


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


PARTS = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "Σ", "'s", "'S", "12", "!", "\xa0", "\r", "<|endoftext|>", "<|", "　", "ﬁ", "\x1c", "中", "İ", ".", "₏", "౜", "🙂", "\U00010940", "-" * 70, "aaaa", "\x00", "\x85"]


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join) | st.text(max_size=40), max_size=4))
def test_ids_and_texts_are_those_of_the_library(texts):
    tool = bpe.codec(PATH)
    for text, ids in zip(texts, tool.encode(texts)):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert decoded(want) == LIBRARY.decode(want, skip_special_tokens=False) == text


def test_any_ids_decode_as_in_the_library():
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(256), rng.randrange(50_257), 60_000]) for _ in range(rng.randrange(12))]
        assert decoded(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert decoded([None, -1, 39]) == LIBRARY.decode([39])


def test_every_sure_character_is_cut_as_by_the_library(codec):
    cut = LIBRARY.pre_tokenizer.pre_tokenize_str
    for first, last in bpe.SURE:
        points = [c for c in range(first, last + 1) if not 0xD800 <= c < 0xE000]
        for at in range(0, len(points), 500):
            text = "".join(f"a{chr(c)}a1{chr(c)}1.{chr(c)}. " for c in points[at : at + 500])
            assert not bpe.UNSURE.search(text)
            assert codec._words(text) == [text[a:b] for _, (a, b) in cut(text)]


def test_all_pairs_of_frequent_tokens_against_merging(codec):
    voc, rng = codec.vocabulary, np.random.default_rng(0)
    left, right = rng.integers(0, 50_256, 4000), rng.integers(0, 3000, 4000)
    same = rng.integers(0, 1000, 200)
    left, right = np.concatenate([left, right, same]), np.concatenate([right, left, same])
    want = [voc.merge(voc.bytes_of[a] + voc.bytes_of[b]) == [a, b] for a, b in zip(left.tolist(), right.tolist())]
    assert voc.compatible(left, right).tolist() == want and 0.1 < np.mean(want) < 1


def vocabulary(tmp_path, merges):
    letters = bpe.byte_letters()
    words = [letters[b] for b in range(256)] + [a + b for a, b in merges]
    spec = json.loads(open(PATH, encoding="utf-8").read())
    spec["model"] |= {"vocab": {w: i for i, w in enumerate(words)}, "merges": [list(m) for m in merges]}
    spec["added_tokens"] = []
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    return str(path)


@settings(max_examples=150, deadline=None)
@given(data=st.data())
def test_small_vocabularies_with_overlapping_merges(data, tmp_path_factory):
    made, merges = ["a", "b"], []
    for _ in range(data.draw(st.integers(1, 9))):
        a, b = data.draw(st.sampled_from(made)), data.draw(st.sampled_from(made))
        if a + b not in made:
            merges.append((a, b))
            made.append(a + b)
    if not merges:
        return
    path = vocabulary(tmp_path_factory.mktemp("v"), merges)
    voc, library = bpe.Vocabulary(path), Tokenizer.from_file(path)
    words = data.draw(st.lists(st.text("ab", min_size=1, max_size=20), max_size=30))
    found, _ = voc.encode_words([w.encode() for w in words])
    assert found == [library.encode(w, add_special_tokens=False).ids for w in words]
    assert [voc.merge(w.encode()) for w in words] == found


def test_proposals_that_stand_are_not_merged(codec, monkeypatch):
    voc = codec.vocabulary
    merged = []
    plain = voc.merge
    monkeypatch.setattr(voc, "merge", lambda w: merged.append(w) or plain(w))
    words = [b" the", b" tokens", b" thehe", b" anst", b" qzxv"] * 3
    found, failing = voc.encode_words(words)
    assert len(merged) == failing < len(words)
    assert all(voc.propose(w) == f for w, f in zip(words, found) if w not in merged)


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    tool = bpe.Codec(PATH)
    for text in ["one two three four five", "", "six seven", "one two " + "x" * 100] * 3:
        assert tool.encode([text, None])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert len(tool.lately) <= 3 and len(tool.older) <= 3


def test_very_long_words(codec):
    rng = random.Random(5)
    for text in ["ab" * 100_000, "".join(rng.choice("abcdehinort") for _ in range(150_000)), " " * 50_000 + "x", "é" * 20_000]:
        (ids,) = codec.encode([text])
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids and decoded(ids) == text


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_both_ways_of_merging_agree(codec, monkeypatch):
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abehinort ") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    want = [codec.vocabulary.merge(w) for w in words]
    monkeypatch.setattr(bpe, "SCANNED", 0)
    assert [codec.vocabulary.merge(w) for w in words] == want


def test_small_blocks_of_ids(spark, monkeypatch):
    texts = ["", "one two three", None, "four", "five six"] * 20
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(bpe, "IDS", 4)
    monkeypatch.setattr(bpe, "BYTES", 9)
    got = bpe.decode_ids(bpe.encode_texts(df, PATH), PATH).orderBy("doc_id").collect()
    assert [r.decoded for r in got] == [t or "" for t in texts]


def test_odd_rows(spark):
    rows = [(1, None, 5), (None, "", 6), (2, "a  b", 7), (2, "a  b", 7), (3, "<|endoftext|>x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    coded = bpe.encode_texts(df, PATH)
    got = bpe.decode_ids(coded, PATH).collect()
    assert [r.doc_id for r in got] == [1, None, 2, 2, 3]
    assert [list(r.ids) for r in got] == [LIBRARY.encode(t or "", add_special_tokens=False).ids for _, t, _ in rows]
    assert [r.decoded for r in got] == ["", "", "a  b", "a  b", "<|endoftext|>x"]
    assert bpe.decode_ids(bpe.encode_texts(df.limit(0), PATH), PATH).collect() == []
    ids = spark.createDataFrame([(None, "x"), ([], "x"), ([64, None, -3, 99_999], "x")], "ids array<int>, decoded string")
    assert [r.decoded for r in bpe.decode_ids(ids, PATH).collect()] == [None, "", "a"]


def test_query_follows_its_contract(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "x <|endoftext|>\n\n y")], docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_bpe"](spark, str(tmp_path)).collect()}
    for row in docs.collect():
        text, r = row.text or "", got.pop(row.doc_id)
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert not got
