"""Token files and packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelflow.llm import packing, rans
from panelflow.llm.queries import QUERIES
from panelflow.llm.tokens import PieceEncoder, encoder
from panelflow.session import materialize, scratch_path

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from(["a", "Bc", " ", "  ", "\n", "\t", "é", "Σ", "'s", "12", "!", "\xa0", "\r", "<|endoftext|>", "　", "é", "ﬁ", "\x1c", "中", "İ", "."]), max_size=12).map("".join))
def test_cut_texts_have_the_ids_of_whole_texts(path, text):
    want = encoder(path).tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder(path).encode_text(text), encoder(path).dtype).tolist() == want


def test_pieces_are_forgotten_in_two_generations(monkeypatch):
    import panelflow.llm.tokens as tokens

    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    enc = PieceEncoder(BYTE)
    for k in range(3):
        for text in ("one two, three four.", "five six seven eight", "x" * 100, None, ""):
            assert np.frombuffer(enc.encode_text(text), enc.dtype).tolist() == enc.tokenizer.encode(text or "", add_special_tokens=False).ids
    assert len(enc.after_space) <= 3


@pytest.mark.parametrize("n", [0, 1, 2, 63, 200, 5000, 70_000, 400_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50_000).astype(np.uint16)
    table = rans.Table.of_counts(np.bincount(ids, minlength=50_257))
    assert int(table.freq.sum()) == 1 << table.bits
    cut = n // 3
    block = rans.encode_block([None, 7], [cut, n - cut], ids, table)
    (payload,) = rans.split_blocks(block + b"\n")
    missing, docs, lengths, back = rans.decode_block(payload, table)
    assert missing.tolist() == [True, False] and docs[1] == 7 and lengths.tolist() == [cut, n - cut]
    assert np.array_equal(back, ids)
    points = rans.INNER.unpack_from(payload)[5]
    apart = [rans.decode_block(payload, table, k, k + 1)[3] for k in range(points)]
    assert n == 0 or np.array_equal(np.concatenate(apart), ids)
    if n == 400_000:
        assert points > 1 and len(block) < 1.3 * n
        damaged = bytearray(block)
        damaged[-9] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            list(rans.split_blocks(bytes(damaged)))
        with pytest.raises(ValueError, match="another table"):
            rans.decode_block(payload, rans.Table.of_counts(np.ones(9, dtype=np.int64)))


DOCS = [(4, "the cat sat"), (2, None), (9, ""), (None, "no id"), (2, "again"), (2, "again"), (11, "word, " * 30_000), (1, "# 2\n\n  #")]


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 500)
    df = spark.createDataFrame(DOCS, "doc_id int, text string").withColumns({"n": F.lit("x"), "ids": F.lit(1)})
    path = scratch_path(spark, "ids")
    rans.write_ids(materialize(rans.tokenized(df, BYTE, 2)), path)
    tk = Tokenizer.from_file(BYTE)
    want = sorted(((d, tk.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in DOCS), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    rows = rans.read_ids(spark, path).orderBy("file", "at").collect()
    assert [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows] == want
    digest = {r["start"]: r for r in rans.read_digest(spark, path).collect()}
    at = 0
    for doc, ids in want:
        r = digest[at]
        assert (r["doc_id"], r["n_tokens"], r["ids_crc32"]) == (doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    empty = scratch_path(spark, "ids")
    rans.write_ids(materialize(rans.tokenized(df.limit(0), BYTE, 2)), empty)
    assert rans.read_digest(spark, empty).count() == 0


def check_packing(rows, docs, capacity, end=0):
    tk = Tokenizer.from_file(WORD)
    want = []
    for doc, text in docs:
        ids = tk.encode(text or "", add_special_tokens=False).ids + [end]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want.append((doc, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


def test_packing_small(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_PIECES", 4)
    df = spark.createDataFrame(DOCS, "doc_id int, text string").withColumns({"length": F.lit("x"), "part": F.lit(1)})
    check_packing(packing.pack_documents(df, WORD, capacity=64).collect(), DOCS, 64)
    assert packing.pack_documents(df.limit(0), WORD).count() == 0


def test_evolution_beats_best_fit():
    rng, sizes = random.Random(5), []
    while len(sizes) < 300:  # thirds that fill bins exactly, hard for best fit
        a, b = rng.randint(200, 500), rng.randint(200, 500)
        sizes += [a, b, 1000 - a - b]
    plain = packing.best_fit(range(len(sizes)), sizes, [], 1000)
    best = packing.evolve(sizes, [], 1000, random.Random(1))[0]
    assert sorted(i for b in best for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 1000 for b in best)
    assert packing.fitness(best, sizes, 1000) >= packing.fitness(plain, sizes, 1000)


def test_queries(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    tk, at = Tokenizer.from_file(BYTE), 0
    digest = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, sf).collect()}
    for doc, text in sorted(docs):
        ids = tk.encode(text, add_special_tokens=False).ids + [2]
        r = digest[doc]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(digest) == len(docs)
    used, least = check_packing(QUERIES["op9_best_fit_packing"](spark, sf).collect(), docs, 2048)
    assert used <= least + 2
