"""Quality scores of documents: histogram gradient-boosted trees over text statistics."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from panelflow.config import ENGLISH_STOP_WORDS, SPANISH_STOP_WORDS
from panelflow.llm.tokens import slices
from panelflow.session import materialize

# Labelled rows that are fitted on, chosen by hash of the id where there are more.
MAX_LABELLED = 20_000
TREES, DEPTH, BINS, RATE, LEAST_ROWS, PENALTY = 60, 4, 64, 0.15, 20, 1.0

STATISTICS = (
    "log_chars log_words mean_word distinct_words repeated_next top_word distinct_pairs upper lower digits spaces marks other_ascii "
    "non_ascii entropy packed stop_words long_words log_lines distinct_lines mean_line marks_doubled capital_words word_spread"
).split()
_STOPS = frozenset([*ENGLISH_STOP_WORDS, *SPANISH_STOP_WORDS])


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 5)
    kinds[0x80:] = 6
    for b in range(0x80):
        c = chr(b)
        kinds[b] = 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 if c.isspace() else 4 if c in ".,;:!?'\"()-" else 5
    return kinds


_KINDS = _byte_kinds()


def statistics(text: str | None) -> list[float]:
    """The values named in ``STATISTICS`` over the whole text; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = text.split(), text.split("\n")
    n, size = max(len(words), 1), max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KINDS, weights=counts, minlength=7) / size
    share = counts[counts > 0] / size
    distinct = Counter(words)
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        float(lengths.mean()) if len(words) else 0.0,
        len(distinct) / n,
        sum(map(eq, words, words[1:])) / n,
        (distinct.most_common(1)[0][1] if words else 0) / n,
        len(set(zip(words, words[1:]))) / n,
        *kinds.tolist(),
        float(-(share * np.log2(share)).sum()),
        len(zlib.compress(raw, 1)) / size,
        sum(c for w, c in distinct.items() if w in _STOPS) / n,
        float((lengths > 12).mean()) if len(words) else 0.0,
        math.log1p(len(lines)),
        len(set(lines)) / len(lines),
        len(words) / len(lines),
        sum(text.count(2 * c) for c in "!?.*#$%&|=-_") / n,
        sum(c for w, c in distinct.items() if w.isupper()) / n,
        float(lengths.std()) if len(words) else 0.0,
    ]


@dataclass
class Forest:
    """Complete trees in arrays: inner node ``k`` leads to ``2k + 1`` and ``2k + 2``."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees of logistic loss, grown level by level on histograms of ``BINS`` bins."""
    inner, width = (1 << DEPTH) - 1, x.shape[1]
    rate = (y.sum() + 1) / (len(y) + 2)
    forest = Forest(math.log(rate / (1 - rate)), np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1)))
    if len(y) < 2 * LEAST_ROWS:
        return forest
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * BINS
    total = np.full(len(y), forest.base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, many = (1 << level) - 1, 1 << level
            slot = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            sums = [
                np.bincount(slot, weights=np.repeat(v, width), minlength=many * width * BINS).reshape(many, width, BINS)
                for v in (g, h, np.ones(len(y)))
            ]
            left = [np.cumsum(s, axis=2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            gain = left[0] ** 2 / (left[1] + PENALTY) + (whole[0] - left[0]) ** 2 / (whole[1] - left[1] + PENALTY) - whole[0] ** 2 / (whole[1] + PENALTY)
            gain[(left[2] < LEAST_ROWS) | (whole[2] - left[2] < LEAST_ROWS)] = 0
            for k in range(many):
                f, b = divmod(int(np.argmax(gain[k])), BINS)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    forest.feature[t, first + k], forest.threshold[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), forest.feature[t, node]] > forest.threshold[t, node])
        leaf = node - inner
        grad, hess = (np.bincount(leaf, weights=v, minlength=inner + 1) for v in (g, h))
        forest.leaf[t] = -RATE * grad / (hess + PENALTY)
        total += forest.leaf[t][leaf]
    return forest


def with_statistics(df: DataFrame, text_col: str, carry: list[str], forest: Forest | None = None, least: float | None = None) -> DataFrame:
    """``carry`` columns with ``_x`` (the statistics) or, given a forest, ``_score``.

    With ``least`` only rows of at least that score are returned.
    """
    inner = df.select(F.col(f"`{text_col}`").cast("string").alias("_text"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)])

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for s in slices(texts):
                x = np.array([statistics(t) for t in texts[s]])
                rest = batch.slice(s.start, s.stop - s.start).columns[1:]
                names = [f"c{k}" for k in range(len(carry))]
                if forest is None:
                    yield pa.RecordBatch.from_arrays([*rest, pa.array(list(x), pa.list_(pa.float64()))], names=[*names, "_x"])
                    continue
                score = forest.scores(x)
                out = pa.RecordBatch.from_arrays([*rest, pa.array(score)], names=[*names, "_score"])
                yield out if least is None else out.filter(pa.array(score >= least))

    kept = [StructField(f"c{k}", inner.schema[f"c{k}"].dataType) for k in range(len(carry))]
    added = _parse_datatype_string("_x array<double>" if forest is None else "_score double").fields
    return inner.mapInArrow(run, StructType([*kept, *added])).select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(carry)], added[0].name
    )


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def labelled_sample(statistics_of: DataFrame, labels: DataFrame, id_col: str, label: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of about ``most`` rows that are not held out, or of all if there are fewer."""
    known = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_y")).filter("_y IN (0, 1)")
    rows = statistics_of.select(F.col(f"`{id_col}`").alias("_id"), "_x").join(known, "_id").filter(~held_out(F.col("_id")))
    total = rows.count()
    if total > most:  # by hash, so that no task sends more than its share
        rows = rows.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < most * 1_000_000 // total)
    taken = rows.toPandas().sort_values(["_id", "_y"])
    x = np.array(taken["_x"].tolist(), dtype=float).reshape(len(taken), len(STATISTICS))
    return x, taken["_y"].to_numpy(dtype=float)


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", most: int = MAX_LABELLED) -> tuple[Forest, DataFrame]:
    """The fitted forest and the written statistics of all rows."""
    table = materialize(with_statistics(df, text_col, [id_col]))
    return fit(*labelled_sample(table, labels, id_col, label, most)), table


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", most: int = MAX_LABELLED) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row; the score is the probability of label 1.

    Labels are learnt only from rows that are not held out.  Rows are scored by statistics of
    their whole text alone; a null or empty text has statistics of its own.  Null ids have no
    label; repeated rows are scored each; labels other than 0 and 1 and null labels are left
    out.  Without labels every score is one half, with too few of them the labels' rate.
    """
    forest, table = train(df, labels, id_col, text_col, label, most)

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(batch.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.scores(x))], names=["id", "score"])

    kind = table.schema[id_col].dataType
    scored = table.select(F.col(f"`{id_col}`").alias("id"), "_x").mapInArrow(
        run, StructType([StructField("id", kind), *_parse_datatype_string("score double").fields])
    )
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Rows of ``df`` that score at least ``least``; same columns, no shuffle of texts."""
    forest, _ = train(df, labels, id_col, text_col)
    return with_statistics(df, text_col, df.columns, forest, least).drop("_score")
