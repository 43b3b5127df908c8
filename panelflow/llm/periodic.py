"""Periodic runs of words by recursive frequency splitting and a scan of lags.

A run of period q repeats its words at least ``min_repeats`` times, so each of its words occurs
at least that often in any stretch that holds the run.  A text is split at every word that is rarer
than this within its current segment; the parts are split anew by their own counts until
nothing changes, and parts too short for a run fall away.  Only what survives is scanned: a run of
period q holds ``min_repeats`` neighbouring multiples of q, so words at those places are compared
for every lag q, then the words between them by hashes, and what is left is extended word by word.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from panelflow.llm.tokens import slices

# Places compared at once, and words compared at once when a run is extended.
BLOCK, STRIDE = 1 << 20, 1 << 12
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def surviving_segments(words: np.ndarray, owner: np.ndarray, least: int, min_length: int) -> list[np.ndarray]:
    """Positions of each segment that no longer splits; ``owner`` is the text of each word, ascending.

    ``words`` are numbers from 0.  Segments that are stable leave the recursion, so only parts of
    segments that were split are counted again.
    """
    at, segment = np.arange(len(words)), owner.astype(np.int64)
    size = int(words.max()) + 1 if len(words) else 1
    done: list[np.ndarray] = []
    while len(at):
        fresh = np.zeros(len(at), dtype=bool)
        fresh[0] = True
        fresh[1:] = (np.diff(at) != 1) | (np.diff(segment) != 0)
        segment = np.cumsum(fresh) - 1
        long = np.bincount(segment)[segment] >= min_length
        at, segment = at[long], segment[long]
        if not len(at):
            break
        _, place, times = np.unique(segment * size + words[at], return_inverse=True, return_counts=True)
        often = times[place] >= least
        split = np.zeros(int(segment[-1]) + 1, dtype=bool)
        split[segment[~often]] = True
        stable = ~split[segment]
        if stable.any():
            kept, ends = at[stable], np.flatnonzero(np.diff(segment[stable])) + 1
            done.extend(np.split(kept, ends))
        again = often & ~stable
        at, segment = at[again], segment[again]
    return done


def _spread(words: np.ndarray) -> np.ndarray:
    """A 64-bit number per word number."""
    x = words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _extent(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest ``[begin, end)`` around ``at`` in which words equal those ``lag`` later."""
    n = len(words) - lag
    end = at
    while end < n:
        stop = min(end + STRIDE, n)
        differ = np.flatnonzero(words[end:stop] != words[end + lag : stop + lag])
        if len(differ):
            end += int(differ[0])
            break
        end = stop
    begin = at
    while begin > 0:
        stop = max(begin - STRIDE, 0)
        differ = np.flatnonzero(words[stop:begin] != words[stop + lag : begin + lag])
        if len(differ):
            begin = stop + int(differ[-1]) + 1
            break
        begin = stop
    return begin, end


def scan_lags(words: np.ndarray, repeats: int, min_length: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs in one segment, for every lag up to its length / ``repeats``.

    About n log n places are compared.  Hashes only choose candidates; runs are confirmed on words.
    A place inside an accepted run of a divisor of its lag belongs to that run: only one run of a
    period can hold it with the following ``repeats - 1`` periods, the last that begins before it.
    """
    n, found = len(words), []
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    step = np.full(n, 0x5851F42D4C957F2D, dtype=np.uint64)
    step[:1] = 1
    power = np.cumprod(step)
    prefix = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_spread(words) * power)])
    lag, last = 1, n // repeats
    while lag <= last:
        begin, size = lag, 0
        while lag <= last and (size == 0 or size + n // lag <= BLOCK):
            size += n // lag
            lag += 1
        lags = np.arange(begin, lag)
        windows = (n - 1) // lags + 2 - repeats
        q = np.repeat(lags, windows)
        at = (np.arange(len(q)) - np.repeat(np.cumsum(windows) - windows, windows)) * q
        for k in range(1, repeats):
            same = words[at + (k - 1) * q] == words[at + k * q]
            q, at = q[same], at[same]
        width = (repeats - 2) * q + 1
        here = (prefix[at + width] - prefix[at]) * power[q]
        same = here == prefix[at + q + width] - prefix[at + q]
        q, at = q[same], at[same]
        edges = np.flatnonzero(np.diff(q)) + 1
        for period, places in zip(q[np.r_[0, edges]].tolist() if len(q) else [], np.split(at, edges)):
            reach = (repeats - 1) * period
            for divisor, (starts, ends) in known.items():
                if period % divisor == 0:
                    near = np.searchsorted(starts, places, "right") - 1
                    places = places[(near < 0) | (places + reach >= ends[near])]
            starts, ends, i = [], [], 0
            while i < len(places):
                start, end = _extent(words, int(places[i]), period)
                end += period
                i += 1
                if end - start >= max(min_length, repeats * period):
                    starts.append(start)
                    ends.append(end)
                    i = max(i, int(np.searchsorted(places, end - reach)))
            if starts:
                known[period] = np.array(starts), np.array(ends)
                found.extend((s, e - s, period) for s, e in zip(starts, ends))
    return found


def longest_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; ties: smallest start, then period."""
    best = None
    for run in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def texts_runs(texts: list[bytes], repeats: int, min_length: int) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Of each text: how many words, its runs by start, then period, and the words outside repetitions joined by one space."""
    split = [t.split() for t in texts]
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    firsts = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(sizes)])
    words = np.fromiter((numbers[w] for ws in split for w in ws), dtype=np.int64, count=int(firsts[-1]))
    owner = np.repeat(np.arange(len(split)), sizes)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for segment in surviving_segments(words, owner, repeats, min_length):
        text = int(owner[segment[0]])
        shift = int(segment[0] - firsts[text])
        runs[text].extend((start + shift, length, period) for start, length, period in scan_lags(words[segment], repeats, min_length))
    out = []
    for own, ws, n in zip(runs, split, sizes.tolist()):
        own.sort(key=lambda r: (r[0], r[2]))
        if own:
            edge = np.zeros(len(ws) + 1, dtype=np.int64)
            for start, length, period in own:
                edge[start + period] += 1
                edge[start + length] -= 1
            ws = [w for w, drop in zip(ws, np.cumsum(edge[:-1]).tolist()) if not drop]
        out.append((n, own, b" ".join(ws)))
    return out


def find_periodic_runs(
    df: DataFrame,
    text_col: str = "text",
    carry: list[str] | None = None,
    min_repeats: int = 4,
    min_length: int = 6,
) -> DataFrame:
    """Maximal periodic runs of the words ``[^\\x20\\x09-\\x0D]+`` of every whole text.

    Columns: those in ``carry`` (default: all but the text; ones called like a new column are left
    out), ``n_words``, ``runs`` (array of start, length, period; by start, then period), ``best``
    (the run of greatest length / period; ties: smallest start, then period; null without runs) and
    ``collapsed`` (the words outside all repetitions, joined by one space).

    A run is a stretch with smallest period q and at least ``max(min_length, min_repeats * q)``
    words that no neighbouring word extends.  All words of a run after its first q are repetitions.
    Null and empty texts have no words, no runs and an empty ``collapsed``.  Rows are judged one by one, so
    repeated and null ids, ties and extra columns do not matter; an empty table gives an empty one.
    A text is one row in one task and costs n log n comparisons for n surviving words.
    """
    if min_repeats < 2:
        raise ValueError("a run needs at least two repeats")
    new = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("best", RUN),
        T.StructField("collapsed", T.StringType()),
    ]
    names = {f.name for f in new}
    kept = [f for f in df.schema if f.name not in names and (f.name in carry if carry is not None else f.name != text_col)]

    def struct(values: list) -> pa.StructArray:
        known = [v or (0, 0, 0) for v in values]
        parts = [pa.array([v[k] for v in known], pa.int64()) for k in range(3)]
        return pa.StructArray.from_arrays(parts, names=RUN.names, mask=pa.array([v is None for v in values], pa.bool_()))

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(0).to_pylist()]
            for s in slices(texts):
                found = texts_runs(texts[s], min_repeats, min_length)
                lists = [runs for _, runs, _ in found]
                ends = np.cumsum([0, *map(len, lists)])
                arrays = [
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct([r for runs in lists for r in runs])),
                    struct([longest_run(runs) for runs in lists]),
                    pa.array([c for _, _, c in found], pa.binary()).cast(pa.string()),
                ]
                columns = [c.slice(s.start, s.stop - s.start) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*columns, *arrays], names=[f.name for f in kept] + [f.name for f in new])

    text = F.col(f"`{text_col}`").cast("string").alias("_0")
    return df.select(text, *[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, T.StructType([*kept, *new]))
