"""Scores of texts by a self-attention model, beside a smoothed word model."""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from panelflow.llm import lm_model as M
from panelflow.llm.tokens import encoder, slices
from panelflow.session import materialize

# The most frequent ids: classes are made of them, and their pair counts stand in a square table.
DENSE_IDS = 1024
# Other pairs whose counts every task holds, at most; counts of all others are joined.
HELD_PAIRS = 400_000
# Texts and ids that a task works on at once, and distinct pairs that it holds.
PORTION_TEXTS, PORTION_IDS, DISTINCT_PAIRS = 200, 300_000, 500_000
# Words whose counts every task holds, at most; counts of all others are joined.
HELD_WORDS = 150_000
# Every window of every task is trained on in each round; a step takes STEP windows.
ROUNDS, STEP = 1, 64
DISTINCT_BEFORE_FLUSH = 300_000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text is divisible by 10; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def _digest(text: bytes | None) -> str:
    return xxhash.xxh3_128_hexdigest(text or b"")


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over all rows of ``docs(text)``; words are counted in each task first."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def flush():
            words = iter(held.items())
            while part := list(islice(words, 50_000)):
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([c for _, c in part], pa.int64())], names=["word", "c"])
            held.clear()

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for s in slices(texts):
                for text in texts[s]:
                    held.update(_words(text))
                if len(held) > DISTINCT_BEFORE_FLUSH:
                    yield from flush()
        yield from flush()

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def word_scores(docs: DataFrame, trained: DataFrame) -> DataFrame:
    """``(row, id, digest, n_tokens, n_known, train_tokens, base_score)`` of ``docs(id, text)``."""
    counts = materialize(word_counts(trained))
    ends = trained.count()
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = total + ends, distinct + (ends > 0)
    # Words by the power of 2 ** (1/8) of their count: a few hundred rows at most.
    power = F.floor(8 * F.log2("c"))
    sizes = sorted(counts.groupBy(power.alias("p")).count().collect(), reverse=True)
    least, taken = 1 << 62, 0
    for r in sizes:
        taken += r["count"]
        if taken > HELD_WORDS:
            break
        least = r["p"]
    often = counts.filter(power >= least).toPandas()
    held = dict(zip(map(bytes, often["word"]), np.log10(often["c"].to_numpy(dtype=float) + 0.1).tolist()))

    def run(batches):
        from pyspark import TaskContext

        row, get = TaskContext.get().partitionId() << 40, held.get
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s in slices(texts):
                out = []
                for text in texts[s]:
                    words = _words(text)
                    found = [x for x in map(get, words) if x is not None]
                    rare = Counter(w for w in words if w not in held) if len(found) < len(words) else {}
                    out.append((row, _digest(text), len(words) + 1, len(found), sum(found), list(rare), list(rare.values())))
                    row += 1
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                cols = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.start, s.stop - s.start), *cols], names=["id", "row", "digest", "n_tokens", "found", "part", "rare", "times"]
                )

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, digest string, n_tokens long, found long, part double, rare array<binary>, times array<long>"
    rows = materialize(docs.select("id", F.col("text").cast("binary")).mapInArrow(run, schema))
    rare = rows.select("row", F.explode(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))).alias("r")).select("row", "r.*")
    others = counts.filter(power < least)
    joined = rare.join(others, "word", "left")
    sums = joined.groupBy("row").agg(
        F.coalesce(F.sum(F.when(F.col("c").isNotNull(), F.col("times"))), F.lit(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("rare_part"),
    )
    known = F.col("found") + F.coalesce("rare_known", F.lit(0)) + int(ends > 0)
    scale = float(np.log10(n + 0.1 * (v + 1)))
    end = float(np.log10(ends + 0.1))
    score = F.col("part") + F.coalesce("rare_part", F.lit(0.0)) + end - F.col("n_tokens") * F.lit(scale)
    return rows.join(sums, "row", "left").select(
        "row", "id", "digest", "n_tokens", known.alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), score.alias("base_score")
    )


def subword_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``(id, digest, held_out, ids)`` of whole texts with an end id, zstd-packed."""

    def run(batches):
        enc = encoder(path)
        end, pack = np.array([end_id], dtype=enc.dtype).tobytes(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for s in slices(texts):
                rest = batch.slice(s.start, s.stop - s.start)
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts[s]]
                ids = [np.frombuffer(i + end, enc.dtype).astype("<u4") for i in enc.encode(texts[s])]
                small = [i.astype("<u2").tobytes() if enc.dtype.itemsize == 2 else i.tobytes() for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        rest.column(0),
                        rest.column(1),
                        pa.array([_digest(t) for t in raw], pa.string()),
                        pa.array([pack.compress(i) for i in small], pa.binary()),
                        pa.array([enc.dtype.itemsize] * len(ids), pa.int32()),
                    ],
                    names=["id", "held_out", "digest", "ids", "width"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "held_out", F.col("text").cast("string")).mapInArrow(
        run, f"id {kind}, held_out boolean, digest string, ids binary, width int"
    )


def _portions(batch: pa.RecordBatch):
    """``(first row, texts' ids)`` of a few rows at a time, so that a batch is never unpacked whole."""
    unpack = zstandard.ZstdDecompressor()
    begin, texts, held = 0, [], 0
    for at, (packed, width) in enumerate(zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist())):
        texts.append(np.frombuffer(unpack.decompress(packed), f"<u{width}").astype(np.int64))
        held += len(texts[-1])
        if len(texts) == PORTION_TEXTS or held >= PORTION_IDS:
            yield begin, texts
            begin, texts, held = at + 1, [], 0
    if texts:
        yield begin, texts


def _unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [t for _, texts in _portions(batch) for t in texts]


def _with_previous(texts: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, previous id, id)`` of every place; ``start`` precedes a text."""
    lengths = np.array([len(t) for t in texts])
    ids = np.concatenate(texts)
    previous = np.concatenate([ids[:1], ids[:-1]])
    previous[(np.cumsum(lengths) - lengths)[lengths > 0]] = start
    return np.repeat(np.arange(len(texts)), lengths), previous, ids


def _summed(frame: DataFrame, size: int, cells) -> np.ndarray:
    """Sums per cell below ``size`` over all tasks; ``cells(batch)`` yields cells and their weights or ``None``."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for cell, n in cells(batch):
                if n is None:
                    total += np.bincount(cell, minlength=size)
                else:
                    np.add.at(total, cell, n)
        used = np.flatnonzero(total)
        for a in range(0, len(used), 100_000):
            part = used[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["cell", "n"])

    found = frame.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros(size, dtype=np.int64)
    sums[found["cell"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return sums


def _id_counts(tokens: DataFrame, size: int) -> np.ndarray:
    def cells(batch):
        encoder.cache_clear()  # the words remembered while texts were encoded are not needed any more
        for _, texts in _portions(batch):
            yield np.concatenate(texts), None

    return _summed(tokens.select("ids", "width"), size, cells)


def _pair_counts(tokens: DataFrame, listed: np.ndarray, start: int) -> DataFrame:
    """``(cell, n)`` of all pairs, ``cell`` being ``previous * start + next``; ``start`` precedes a text."""

    def run(batches):
        held = []

        def flush():
            cells, back = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([n for _, n in held])).astype(np.int64)
            held.clear()
            for a in range(0, len(cells), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(cells[a : a + 100_000]), pa.array(counts[a : a + 100_000])], names=["cell", "n"])

        for batch in batches:
            for _, texts in _portions(batch):
                _, previous, ids = _with_previous([listed[t] for t in texts], start)
                held.append(np.unique(previous * start + ids, return_counts=True))
                if sum(len(c) for c, _ in held) > DISTINCT_PAIRS:
                    yield from flush()
        if held:
            yield from flush()

    return tokens.select("ids", "width").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _largest_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The pairs that tasks hold, at most ``HELD_PAIRS``, and the others, ``None`` if there are none."""
    # By the power of 2 ** (1/8) of their count: a few hundred rows at most.
    power = F.floor(8 * F.log2("n"))
    least, taken = 1 << 62, 0
    for r in sorted(pairs.groupBy(power.alias("p")).count().collect(), reverse=True):
        taken += r["count"]
        if taken > HELD_PAIRS:
            return pairs.filter(power >= least), pairs.filter(power < least)
        least = r["p"]
    return pairs, None


def _all_classes(pairs: DataFrame, dense: M.Pairs, ids: int, width: int) -> np.ndarray:
    """The class of each id; beyond the dense ones, that whose members have the most similar neighbours."""
    if ids <= len(dense.classes):
        return dense.classes[:ids]
    many, first = M.CLASSES + 1, np.full(ids + 1, M.CLASSES)
    first[: len(dense.classes)] = dense.classes

    def cells(batch):
        before, after = np.divmod(batch.column("cell").to_numpy(), width)
        n = batch.column("n").to_numpy()
        yield np.minimum(before, ids) * many + first[after], n
        yield (ids + 1 + after) * many + first[np.minimum(before, ids)], n

    sides = _summed(pairs, 2 * (ids + 1) * many, cells).reshape(2, ids + 1, many)[:, :ids]
    x = np.concatenate([np.sqrt(s / np.maximum(s.sum(axis=1, keepdims=True), 1)) for s in sides], axis=1)
    centres = np.zeros((M.CLASSES, 2 * many))
    np.add.at(centres, dense.classes, x[: len(dense.classes)])
    centres /= np.maximum(np.bincount(dense.classes, minlength=M.CLASSES), 1)[:, None]
    near = np.argmax(x @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
    near[: len(dense.classes)] = dense.classes
    return near


def _train_round(tokens: DataFrame, params: M.Params, pairs: M.Pairs, listed: np.ndarray, start: int) -> tuple[M.Params, int]:
    """Every task trains on its windows; the tasks' parameters are averaged by windows.

    Also returns how many windows were trained on.
    """

    def run(batches):
        adam, used, held = M.Adam(params), 0, []

        def step(part):
            _, grads = M.gradients(adam.params, part[0], pairs.classes[part[1]], part[2], pairs)
            adam.step(grads)

        for batch in batches:
            for _, texts in _portions(batch):
                _, _, *part = M.text_windows([listed[t] for t in texts], start)
                held.append(tuple(part))
                if sum(len(h[0]) for h in held) >= STEP:
                    whole = [np.concatenate(c) for c in zip(*held)]
                    ready = len(whole[0]) // STEP * STEP
                    for b in range(0, ready, STEP):
                        step([c[b : b + STEP] for c in whole])
                    used += ready
                    held = [tuple(c[ready:] for c in whole)]
        if held and len(rest := np.concatenate([h[0] for h in held])):
            step([np.concatenate(c) for c in zip(*held)])
            used += len(rest)
        if used:
            yield pa.RecordBatch.from_arrays([pa.array([float(used)]), pa.array([M.flat(adam.params).tolist()], pa.list_(pa.float64()))], names=["w", "p"])

    local = materialize(tokens.select("ids", "width").mapInArrow(run, "w double, p array<double>"))
    # As many rows as the model has numbers.
    mean = local.select("w", F.posexplode("p")).groupBy("pos").agg((F.sum(F.col("w") * F.col("col")) / F.sum("w")).alias("p"))
    found = mean.toPandas().sort_values("pos")
    used = local.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    return (M.shaped(found["p"].to_numpy(), params) if len(found) else params), int(used)


def model_scores(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``(id, digest, score)`` of distinct texts: log10 probability by the trained model."""
    tokens = materialize(subword_ids(docs, path, end_id))
    size = encoder(path).tokenizer.get_vocab_size()
    known = tokens.filter("NOT held_out")
    counts = _id_counts(known, size)
    # Every id of a training text by falling count, then all unseen ones as one: their counts are equal.
    used = int((counts > 0).sum())
    listed = np.full(size, used, dtype=np.int64)
    listed[np.argsort(-counts, kind="stable")[:used]] = np.arange(used)
    start, unseen = used + 1, size - used
    weight = np.bincount(listed, weights=counts + 0.1, minlength=start)
    overall = weight / weight.sum()
    cells = materialize(_pair_counts(known, listed, start))
    before, after = F.floor(F.col("cell") / start), F.col("cell") % start
    dense = min(used, DENSE_IDS)
    inside = (after < dense) & (before < dense)
    found = cells.filter(inside | ((after < dense) & (before == start))).toPandas().to_numpy(dtype=np.int64)
    square = np.zeros((dense + 1, dense))
    square[np.minimum(found[:, 0] // start, dense), found[:, 0] % start] = found[:, 1]
    by_count = np.sort(counts)[::-1].astype(float)
    of_dense = M.pair_tables(square, by_count[:dense]) if dense else M.Pairs(square, square, np.zeros(0, dtype=np.int64))
    classes = np.append(_all_classes(cells, of_dense, used, start), 0)
    of_class = np.bincount(classes, weights=overall, minlength=M.CLASSES)

    def by_class(batch):
        previous, following = np.divmod(batch.column("cell").to_numpy(), start)
        yield previous * M.CLASSES + classes[following], batch.column("n").to_numpy()

    follows = _summed(cells, (start + 1) * M.CLASSES, by_class).reshape(start + 1, M.CLASSES)
    every = follows.sum(axis=1) + M.SMOOTHING
    log_class = np.log((follows + M.SMOOTHING * of_class) / every[:, None] + 1e-30).astype(np.float32)
    pairs = M.Pairs(np.zeros((0, 0), np.float32), log_class, classes)
    params = M.begin(start + 1)
    for _ in range(ROUNDS):
        params, _ = _train_round(known, params, pairs, listed, start)

    least, log_every = M.SMOOTHING * overall, np.log(every)
    large, rest = _largest_pairs(cells.filter(~inside))
    largest = large.toPandas().sort_values("cell").to_numpy(dtype=np.int64)
    held, held_log = largest[:, 0].copy(), np.log(largest[:, 1] + least[largest[:, 0] % start])
    square_log = np.log(square[:dense] + least[:dense]).astype(np.float32)
    joined = rest is not None

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, texts in _portions(batch):
                texts = [listed[t] for t in texts]
                total = M.score_texts(params, pairs, texts, start)
                text, previous, ids = _with_previous(texts, start)
                both = (previous < dense) & (ids < dense)
                logp = np.empty(len(ids))
                logp[both] = square_log[previous[both], ids[both]]
                place = np.flatnonzero(~both)
                cell = previous[place] * start + ids[place]
                at = np.minimum(np.searchsorted(held, cell), max(len(held) - 1, 0))
                hit = held[at] == cell if len(held) else np.zeros(len(cell), dtype=bool)
                logp[place[hit]] = held_log[at[hit]]
                place, cell = place[~hit], cell[~hit]
                # Pairs that are not held do not occur, or are looked up by the join.
                logp[place] = 0 if joined else np.log(least[ids[place]])
                logp -= log_every[previous] + np.where(ids == used, np.log(max(unseen, 1)), 0)
                total += np.bincount(text, weights=logp, minlength=len(texts))
                if not joined:
                    place, cell = place[:0], cell[:0]
                ends = pa.array(np.cumsum([0, *np.bincount(text[place], minlength=len(texts))]), pa.int32())
                rows = batch.slice(first, len(texts))
                lists = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (cell, least[ids[place]])]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("digest"), pa.array(range(row, row + len(texts))), pa.array(total), *lists],
                    names=["id", "digest", "row", "part", "cells", "least"],
                )
                row += len(texts)

    kind = tokens.schema["id"].dataType.simpleString()
    schema = f"id {kind}, digest string, row long, part double, cells array<long>, least array<double>"
    scored = tokens.select("id", "digest", "ids", "width").mapInArrow(run, schema)
    score = F.col("part")
    if joined:
        scored = materialize(scored)
        missed = scored.select("row", F.inline(F.arrays_zip(F.col("cells").alias("cell"), "least")))
        # A pair never seen in training has no count.
        log = F.log(F.coalesce("n", F.lit(0)) + F.col("least"))
        sums = missed.join(rest, "cell", "left").groupBy("row").agg(F.sum(log).alias("rare"))
        scored = scored.join(sums, "row", "left")
        score = score + F.coalesce("rare", F.lit(0.0))
    return scored.groupBy("id", "digest").agg(F.max(score / float(np.log(10))).alias("score"))


def score_texts(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Learns from the rows that are not held out.  ``base_score`` is the log10 probability of the
    words and an end by smoothed counts over all of those rows; ``score`` that of the subword
    ids and an end by the attention model (``lm_model``), each id scored in one of overlapping
    windows.  Every id of a training text has a vector and exact pair counts; gradients are taken on
    all windows of all training texts, ``ROUNDS`` times.

    A null text counts as empty and has just the end.  A null id is not held out.  Repeated
    rows count and are scored each.  Without training rows all counts are 0.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = docs.withColumn("held_out", held_out(F.col("id")))
    words = word_scores(docs.select("id", "text"), docs.filter("NOT held_out").select("text"))
    scores = model_scores(docs, path, end_id).select(F.col("id").alias("m_id"), F.col("digest").alias("m_digest"), "score")
    same = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("digest") == F.col("m_digest"))
    return words.join(scores, same).select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
