"""Benchmark passages in training texts, found by suffix arrays over shards of the texts."""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from panelflow.llm.tokens import slices
from panelflow.session import materialize

WINDOW = 13
# Benchmark characters whose suffixes a task holds at a time; more are taken in blocks.
BLOCK_CHARS = 8_000_000

# A word is a run of ASCII letters and digits and of any non-ASCII characters.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

MATCHES = "array<struct<item_id:string,begin:int,length:int,item_begin:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


class TestSuffixes:
    """Windows of benchmark items as rows of word numbers; 0 is any other word."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.items, self.numbers = [], {}
        rows, owners, places, sizes = [], [], [], []
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            size = min(window, len(words))
            for p in range(len(words) - size + 1 if size else 0):
                rows.append(words[p : p + size] + [0] * (window - size))
                owners.append(len(self.items))
                places.append(p)
                sizes.append(size)
            self.items.append(item)
        self.window = window
        self.keys = _keys(np.array(rows, dtype=np.uint32).reshape(len(rows), window))
        self.owners, self.places, self.sizes = (np.array(x, dtype=np.int64) for x in (owners, places, sizes))
        self.least = int(self.sizes.min()) if rows else window + 1

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place in ids, window)`` of every occurrence in a shard's word numbers.

        The suffix array holds the suffixes that begin with as many listed words as the
        shortest window has, since no other can match; each window is then a binary search.
        """
        stops = np.flatnonzero(ids == 0)
        run = stops[np.searchsorted(stops, np.arange(len(ids)))] - np.arange(len(ids))
        begins = np.flatnonzero(run >= self.least)
        if not len(begins) or not len(self.keys):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        padded = np.concatenate([ids, np.zeros(self.window, dtype=ids.dtype)])
        heads = np.stack([np.where(run[begins] > k, padded[begins + k], 0) for k in range(self.window)], axis=1)
        keys = _keys(heads.astype(np.uint32))
        order = np.argsort(keys, kind="stable")
        suffixes, keys = begins[order], keys[order]
        low = np.searchsorted(keys, self.keys, "left")
        high = np.empty_like(low)
        for size in np.unique(self.sizes):  # a short window matches every suffix that begins with it
            own = self.sizes == size
            width = 4 * int(size)
            high[own] = np.searchsorted(keys.astype(f"S{width}"), self.keys[own].astype(f"S{width}"), "right")
            low[own] = np.searchsorted(keys.astype(f"S{width}"), self.keys[own].astype(f"S{width}"), "left")
        found = np.flatnonzero(high > low)
        n = high[found] - low[found]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return suffixes[np.repeat(low[found], n) + within], np.repeat(found, n)


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings of the same order."""
    width = rows.shape[1]
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * width}").reshape(-1) if len(rows) else np.zeros(0, dtype=f"S{4 * width}")


def _matches(places: np.ndarray, windows: np.ndarray, test: TestSuffixes) -> list[tuple[int, int, int, int]]:
    """``(item, begin, length, item begin)``: windows that continue one another become one match."""
    item, p, size = test.owners[windows], test.places[windows], test.sizes[windows]
    order = np.lexsort((places, places - p, item))
    item, at, p, size = item[order], places[order], p[order], size[order]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (item[1:] != item[:-1]) | (at[1:] - p[1:] != at[:-1] - p[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1
    return list(zip(item[first].tolist(), at[first].tolist(), (at[last] + size[last] - at[first]).tolist(), p[first].tolist()))


def _search_block(rows: DataFrame, items: list[tuple[str, bytes | None]], window: int, carry: list[str]) -> DataFrame:
    def run(batches):
        test = TestSuffixes(items, window)
        for batch in batches:
            text = batch.column(0).cast(pa.binary()).to_pylist()
            earlier = batch.column(1).to_pylist()
            for s in slices(text):
                shard = [words_of(t) for t in text[s]]
                n = np.array([len(w) for w in shard], dtype=np.int64)
                number = test.numbers.get
                ids = np.fromiter(chain.from_iterable(chain(map(number, w, repeat(0)), (0,)) for w in shard), np.uint32, int(n.sum()) + len(n))
                begins = np.cumsum(n + 1) - (n + 1)
                places, windows = test.search(ids)
                owner = np.searchsorted(begins, places, "right") - 1
                order = np.argsort(owner, kind="stable")
                places, windows, owner = places[order], windows[order], owner[order]
                found = [list(m) for m in earlier[s]]
                for d in np.unique(owner).tolist():
                    a, b = np.searchsorted(owner, [d, d + 1])
                    for item, at, length, p in _matches(places[a:b] - begins[d], windows[a:b], test):
                        found[d].append({"item_id": test.items[item], "begin": at, "length": length, "item_begin": p})
                part = batch.slice(s.start, s.stop - s.start)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(2 + k) for k in range(len(carry))), pa.array(found, _MATCH_TYPE), pa.array(n, pa.int64())],
                    names=[*(f"c{k}" for k in range(len(carry))), "_matches", "_n_words"],
                )

    inner = rows.select(F.col("_text"), F.col("_matches"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)])
    kept = [StructField(f"c{k}", inner.schema[f"c{k}"].dataType) for k in range(len(carry))]
    added = _parse_datatype_string(f"_matches {MATCHES}, _n_words long")
    return inner.mapInArrow(run, StructType([*kept, *added.fields])).select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(carry)], "_matches", "_n_words"
    )


_MATCH_TYPE = pa.list_(
    pa.struct([("item_id", pa.string()), ("begin", pa.int32()), ("length", pa.int32()), ("item_begin", pa.int32())])
)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    carry: list[str] | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` (its columns in ``carry``, all by default) with the matches of benchmark items.

    Added, replacing columns of these names: ``matches`` (item, first word, words and first word
    in the item of each longest verbatim match of at least a window), ``n_words``, ``n_hit``
    (words inside matches), ``n_items``, ``items_sha256`` (sorted item ids, comma-joined) and
    ``contaminated`` (at least one word in twenty is hit).

    A window is ``window`` consecutive words; an item of fewer, but not none, is one window.
    Each slice of a task's documents is a shard with a suffix array of its own, in which the
    benchmark's suffixes are looked up by binary search, so documents are not shuffled.  The
    benchmark is taken in blocks of about ``block_chars`` characters, one pass each.

    A null text or item has no words; a null item id is reported as ``null``.  Repeated items
    count once in ``n_items``.
    """
    names = list(docs.columns if carry is None else carry)
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"), F.col(f"`{item_text}`").cast("string").alias("text")
    ).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    rows = docs.withColumns({"_text": F.col(f"`{text_col}`").cast("string"), "_matches": F.lit(None).cast(MATCHES)})
    rows = rows.withColumn("_matches", F.coalesce("_matches", F.array().cast(MATCHES)))
    for k in range(blocks):
        held = [(r["item"], (r["text"] or "").encode()) for r in dealt.filter(F.col("block") == k).collect()]
        last = k == blocks - 1
        rows = _search_block(rows, held, window, names if last else [*names, "_text"])
        if not last:
            rows = materialize(rows)
    words = F.flatten(F.transform("_matches", lambda m: F.sequence(m["begin"], m["begin"] + m["length"] - 1)))
    ids = F.array_sort(F.array_distinct(F.transform("_matches", lambda m: m["item_id"])))
    out = rows.withColumns(
        {
            "matches": F.col("_matches"),
            "n_words": F.col("_n_words"),
            "n_hit": F.size(F.array_distinct(words)).cast("long"),
            "n_items": F.size(ids).cast("long"),
            "items_sha256": F.sha2(F.array_join(ids, ","), 256),
        }
    ).drop("_matches", "_n_words")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; same columns."""
    added = ["matches", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    held = docs.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(docs.columns)])
    text = f"_c{docs.columns.index(options.pop('text_col', 'text'))}"
    clean = find_contamination(held, benchmark, text_col=text, **options).filter(~F.col("contaminated")).drop(*added)
    return clean.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(docs.columns)])
