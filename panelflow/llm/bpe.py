"""Byte-level BPE by speculation: greedy tokens, tested pair by pair; only failing words are merged.

A word (a piece that the vocabulary's pattern cuts off) is first covered by the longest tokens
from the left.  Merging would end in just these tokens if each token's own bytes merge to it and
no merge ever crosses from a token to the next.  The second is a property of the two tokens
alone: symbols at the end of the left one and at the start of the right one each live from the
merge that forms them to the merge that uses them up, and a merge of two such symbols that live
at the same time, with a rank before either is used up, would have crossed.  All distinct pairs of a
batch are tested at once with numpy; words with a crossing pair are merged step by step.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from panelflow.llm.tokens import byte_letters

PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Blocks whose letters, numbers and spaces are the same in every Unicode version in use; a text
# with other characters is cut by the tokenizers library, whose tables may be older or newer.
SURE = ((0x0000, 0x0557), (0x0900, 0x0C5B), (0x1E00, 0x206F), (0x2100, 0xA7CD), (0xAC00, 0xFFFF), (0x1F000, 0x1FAFF))
UNSURE = regex.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SURE) + "]")
NO_RANK = 1 << 60
NEVER = np.int64(NO_RANK)
# Words remembered per worker (twice as many at most), and the longest that is remembered.
KEPT_WORDS, KEPT_CHARS = 160_000, 40
# Bytes encoded and ids decoded at once.
BYTES, IDS = 1_000_000, 300_000
# Tokens are looked for by their first bytes.
STEM, SHORTER = 4, (3, 2, 1)
# Shorter words are merged by looking at all their pairs, longer ones with a heap.
SCANNED = 48


class Vocabulary:
    """Tokens, merges and what a merge may cross, from a tokenizer file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        byte_level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        if model.get("type") != "BPE" or not plain or not byte_level or spec.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        self.path = path
        byte_of = {letter: b for b, letter in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that trim or match by word are not supported")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

        whole = {i: bytes(byte_of[c] for c in word) for word, i in model["vocab"].items()}
        self.bytes_of = whole | {i: word.encode() for word, i in self.special.items()}
        size = max(self.bytes_of) + 1
        ids = {b: i for i, b in whole.items()}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.born = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, made = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if self.born[made] >= 0 or len(whole[made]) < 2 or max(self.born[x], self.born[y]) >= rank:
                raise ValueError("merges must each make a token of their own, after its parts")
            self.born[made], self.left[made], self.right[made] = rank, x, y
            self.merges[x, y] = rank, made
        self.size = size
        keys = np.array([x * size + y for x, y in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)

        # Tokens that their own bytes merge to; only these are proposed.
        made = np.flatnonzero(self.born >= 0)
        made = made[np.argsort(self.born[made])]
        sound = np.ones(size, dtype=bool)
        apart = self.compatible(self.left[made], self.right[made], joined=True)
        for token, ok in zip(made.tolist(), apart.tolist()):
            sound[token] = ok and sound[self.left[token]] and sound[self.right[token]]
        self.ids = {b: i for b, i in ids.items() if sound[i]}
        lengths: dict[bytes, set[int]] = {}
        for b in self.ids:
            if len(b) >= STEM:
                lengths.setdefault(b[:STEM], set()).add(len(b))
        self.lengths = {stem: (*sorted(n, reverse=True), *SHORTER) for stem, n in lengths.items()}

    def _rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), max(len(self.pair_keys) - 1, 0))
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER) if len(self.pair_keys) else np.full(len(key), NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray, joined: bool = False) -> np.ndarray:
        """Whether no merge crosses between the tokens; ``joined``: before they are merged themselves.

        Goes back in time from the finished tokens, undoing the later of the two last merges.
        Of merges with one rank the leftmost comes first: one inside the left token is then
        before the crossing, one inside the right token after it.
        """
        ok, rows = np.ones(len(left), dtype=bool), np.arange(len(left))
        x, y = left.astype(np.int64), right.astype(np.int64)
        x_used, y_used = np.full(len(x), NEVER), np.full(len(x), NEVER)
        while len(rows):
            rank = self._rank(x, y)
            crossed = (rank < x_used) & (rank <= y_used)
            if joined:
                crossed[:], joined = False, False
            ok[rows[crossed]] = False
            x_born, y_born = self.born[x], self.born[y]
            go = ~crossed & ((x_born >= 0) | (y_born >= 0))
            rows, x, y, x_used, y_used, x_born, y_born = (v[go] for v in (rows, x, y, x_used, y_used, x_born, y_born))
            back = x_born > y_born
            x_used, y_used = np.where(back, x_born, x_used), np.where(back, y_used, y_born)
            x, y = np.where(back, self.right[x], x), np.where(back, y, self.left[y])
        return ok

    def propose(self, word: bytes) -> list[int]:
        """The longest token at every place, from the left."""
        ids, lengths = self.ids, self.lengths
        if word in ids:
            return [ids[word]]
        out, at, n = [], 0, len(word)
        while at < n:
            for k in lengths.get(word[at : at + STEM], SHORTER):
                part = word[at : at + k]
                if part in ids:
                    out.append(ids[part])
                    at += len(part)
                    break
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the lowest rank, leftmost first; n log n for a long word of n bytes."""
        tokens = [self.byte_ids[b] for b in word]
        n, merges = len(tokens), self.merges
        if n <= SCANNED:
            none = (NO_RANK, -1)
            found = [merges.get(pair, none) for pair in zip(tokens, tokens[1:])]
            while found:
                best = min(found)
                if best is none:
                    break
                i = found.index(best)
                tokens[i : i + 2] = [best[1]]
                del found[i]
                if i:
                    found[i - 1] = merges.get((tokens[i - 1], best[1]), none)
                if i < len(found):
                    found[i] = merges.get((best[1], tokens[i + 1]), none)
            return tokens
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(found[0], i, tokens[i], tokens[i + 1]) for i in range(n - 1) if (found := merges.get((tokens[i], tokens[i + 1])))]
        heapq.heapify(waiting)
        while waiting:
            _, i, x, y = heapq.heappop(waiting)
            j = after[i]
            if tokens[i] != x or j >= n or tokens[j] != y:
                continue
            tokens[i], tokens[j] = merges[x, y][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((tokens[i], tokens[k])):
                    heapq.heappush(waiting, (found[0], i, tokens[i], tokens[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((tokens[h], tokens[i]))):
                heapq.heappush(waiting, (found[0], h, tokens[h], tokens[i]))
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: Sequence[bytes]) -> tuple[list[list[int]], int]:
        """Tokens of every word, and how many words had to be merged."""
        found = [self.propose(w) for w in words]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(counts.sum()))
        word = np.repeat(np.arange(len(found)), counts)
        inside = np.flatnonzero(word[1:] == word[:-1]) if len(flat) else np.zeros(0, dtype=np.int64)
        pairs, place = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        ok = self.compatible(pairs // self.size, pairs % self.size)
        failing = np.unique(word[inside[~ok[place]]])
        for i in failing.tolist():
            found[i] = self.merge(words[i])
        return found, len(failing)


class Codec:
    """Encodes whole texts; remembers the words met lately."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.letter = "H" if self.vocabulary.size <= 1 << 16 else "I"
        self.code = np.dtype(self.letter)
        self.lately: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._library = None

    def _words(self, text: str) -> list[str]:
        if not UNSURE.search(text):
            return PATTERN.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.vocabulary.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _parts(self, text: str) -> list[str]:
        """Words, and special tokens as they stand in the text."""
        if self.vocabulary.cut is None or not self.vocabulary.cut.search(text):
            return self._words(text)
        parts = self.vocabulary.cut.split(text)
        return list(chain.from_iterable([p] if i % 2 else self._words(p) for i, p in enumerate(parts) if p))

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        parts = [self._parts(t) if t else [] for t in texts]
        known = {word: np.array([i], dtype=self.code).tobytes() for word, i in self.vocabulary.special.items()}
        new = []
        for word in set(chain.from_iterable(parts)) - known.keys():
            ids = self.lately.get(word) or self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                known[word] = ids
        found, _ = self.vocabulary.encode_words([w.encode() for w in new])
        for word, tokens in zip(new, found):
            known[word] = array(self.letter, tokens).tobytes()
        if len(self.lately) >= KEPT_WORDS:
            self.older, self.lately = self.lately, {}
        room = KEPT_WORDS - len(self.lately)
        for word in new:
            if room <= 0:
                break
            if len(word) <= KEPT_CHARS:
                self.lately[word] = known[word]
                room -= 1
        return [np.frombuffer(b"".join(map(known.__getitem__, p)), self.code) for p in parts]


class Decoder:
    """Only what decoding needs: the bytes of all tokens one after another."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: b for b, letter in byte_letters().items()}
        table = {i: bytes(byte_of[c] for c in word) for word, i in spec["model"]["vocab"].items()}
        table |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        tokens = [table.get(i, b"") for i in range(max(table) + 1)]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of ``sizes`` ids each; ids outside the vocabulary count for nothing, bad UTF-8 becomes U+FFFD."""
        known = (ids >= 0) & (ids < len(self.lengths))
        ids = np.where(known, ids, 0).astype(np.int64)
        lengths = np.where(known, self.lengths[ids], 0)
        ends = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(lengths)])
        data = self.bytes[np.repeat(self.starts[ids] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
        cuts = ends[np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(sizes)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    """One per Python worker and file."""
    return Decoder(path)


def row_blocks(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of about ``most`` in sum; a larger row stands by itself or ends its range."""
    cuts = (np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(sizes)]))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker and file."""
    return Codec(path)


def _carried(df: DataFrame, *without: str) -> list[T.StructField]:
    return [f for f in df.schema if f.name not in without]


def encode_texts(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of every whole text in ``ids_col`` (array<int>) in place of ``text_col``.

    ``path`` must be readable by every executor (a tokenizer file as the tokenizers library writes it).
    Null and empty texts give an empty array.  Strings of special tokens become these tokens.  Rows
    are neither merged nor told apart, so repeated and null ids are kept; a column that is
    already called ``ids_col`` is replaced; an empty table gives an empty one.  A text is read as one
    row by one task; within it time grows as n log n even for a single word.
    """
    rest = _carried(df, text_col, ids_col)
    names = [f.name for f in rest]

    def run(batches):
        tool = codec(path)
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(0)), 0)).astype(np.int64)
            for a, b in row_blocks(sizes, BYTES):
                ids = tool.encode(batch.column(0).slice(a, b - a).to_pylist())
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids) if len(ids) else np.zeros(0, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))
                columns = [c.slice(a, b - a) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*names, ids_col])

    text = F.col(f"`{text_col}`").cast("string")
    slim = df.select(text.alias("_0"), *[F.col(f"`{f.name}`") for f in rest])
    return slim.mapInArrow(run, T.StructType([*rest, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of the token ids in ``ids_col``.

    Null ids give null, an empty array the empty text; null or unknown ids inside an array count for
    nothing, and bytes that are no UTF-8 become U+FFFD.  A column already called ``text_col`` is replaced.
    """
    rest = _carried(df, text_col)
    names = [f.name for f in rest]

    def run(batches):
        tool = decoder(path)
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.list_value_length(batch.column(0)), 0)).astype(np.int64)
            for a, b in row_blocks(sizes, IDS):
                lists = batch.column(0).slice(a, b - a)
                texts = tool.decode(np.asarray(pc.fill_null(lists.flatten(), -1)), sizes[a:b])
                decoded = pa.array(texts, pa.string(), mask=np.asarray(lists.is_null()))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[1:]), decoded], names=[*names, text_col])

    slim = df.select(F.col(f"`{ids_col}`").alias("_0"), *[F.col(f"`{f.name}`") for f in rest])
    return slim.mapInArrow(run, T.StructType([*rest, T.StructField(text_col, T.StringType())]))
