"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import random
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from panelflow.llm.tokens import encoder, slices
from panelflow.session import materialize

CAPACITY = 2048
# Pieces solved together; every piece is in exactly one such part.
PART_PIECES = 8192
ISLANDS, ROUNDS = 2, 2
POPULATION, GENERATIONS = 4, 6

PIECE_SCHEMA = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

Bins = list[list[int]]


def cut_pieces(
    df: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of up to ``capacity`` ids of every whole text and ``end_id``; ``row`` numbers them."""

    def run(batches):
        enc, row = encoder(path), TaskContext.get().partitionId() << 40
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s in slices(texts):
                out = []
                for doc, raw in zip(docs[s], enc.encode(texts[s])):
                    ids = np.frombuffer(raw + end, enc.dtype).astype("<u4")
                    for k in range(0, len(ids), capacity):
                        part = ids[k : k + capacity]
                        out.append((row, doc, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
                        row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["row", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(run, PIECE_SCHEMA)


def best_fit(items: Sequence[int], sizes: list[int], bins: Bins, capacity: int) -> Bins:
    """Puts items, longest first, where the least room is left.  ``room`` marks rooms in bits."""
    by_room: dict[int, list[int]] = {}
    room = 0
    for b, members in enumerate(bins):
        left = capacity - sum([sizes[i] for i in members])
        by_room.setdefault(left, []).append(b)
        room |= 1 << left
    for i in sorted(items, key=sizes.__getitem__, reverse=True):
        size = sizes[i]
        fits = room >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            held = by_room[left]
            b = held.pop()
            if not held:
                room ^= 1 << left
            bins[b].append(i)
            left -= size
        else:
            b, left = len(bins), capacity - size
            bins.append([i])
        by_room.setdefault(left, []).append(b)
        room |= 1 << left
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins filled unevenly, which are easier to improve."""
    return -len(bins), sum([sum([sizes[i] for i in b]) ** 2 for b in bins]) / capacity**2


def crossover(into: Bins, giver: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Whole well-filled bins of ``giver`` enter ``into``; what they displace is placed by best fit."""
    filled = sorted(giver, key=lambda b: -sum([sizes[i] for i in b]))
    chosen = [b for b in filled[: max(1, len(filled) // 2)] if rng.random() < 0.5] or filled[:1]
    inside = {i for b in chosen for i in b}
    kept, displaced = [list(b) for b in chosen], []
    for b in into:
        if inside.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in inside]
    return best_fit(displaced, sizes, kept, capacity)


def mutate(bins: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Empties the emptiest bins and a few others and places their pieces anew."""
    order = sorted(range(len(bins)), key=lambda b: sum([sizes[i] for i in bins[b]]))
    out = set(order[: max(2, len(order) // 50)]) | {rng.randrange(len(bins)) for _ in range(max(2, len(bins) // 50))}
    kept = [list(b) for k, b in enumerate(bins) if k not in out]
    return best_fit([i for k in out for i in bins[k]], sizes, kept, capacity)


def evolve(sizes: list[int], population: list[Bins], capacity: int, rng: random.Random) -> list[Bins]:
    """Sorted, best first.  Stops where no packing can use fewer bins."""
    least = -(-sum(sizes) // capacity)
    while len(population) < POPULATION:  # the first is plain best fit, others begin with random bins
        head = rng.sample(range(len(sizes)), min(len(sizes), len(sizes) // 8 * min(1, len(population))))
        begun = best_fit(head, sizes, [], capacity)
        taken = set(head)
        population.append(best_fit([i for i in range(len(sizes)) if i not in taken], sizes, begun, capacity))
    rank = lambda b: fitness(b, sizes, capacity)
    population.sort(key=rank, reverse=True)
    for _ in range(GENERATIONS):
        if len(population[0]) <= least:
            break
        a, b = rng.sample(range(len(population)), 2)
        child = crossover(population[a], population[b], sizes, capacity, rng)
        population += [child, mutate(population[0], sizes, capacity, rng)]
        population.sort(key=rank, reverse=True)
        del population[POPULATION:]
    return population


def _packed(bins: Bins) -> bytes:
    """Bin of each piece."""
    where = np.zeros(sum(map(len, bins)), dtype="<i4")
    for k, b in enumerate(bins):
        where[b] = k
    return where.tobytes()


def _unpacked(where: bytes) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(np.frombuffer(where, "<i4").tolist()):
        bins.setdefault(k, []).append(i)
    return list(bins.values())


ELITE_SCHEMA = "part long, island int, bins int, packing binary"


def _island(capacity: int, number: int):
    def run(key, pieces: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        if not len(pieces):
            return pd.DataFrame({"part": [], "island": [], "bins": [], "packing": []})
        part, island = int(key[0]), int(key[1])
        sizes = pieces.sort_values("row")["length"].tolist()
        begun = [_unpacked(w) for w in elites.sort_values("bins")["packing"]]
        best = evolve(sizes, begun, capacity, random.Random(f"{part}/{island}/{number}"))[:2]
        return pd.DataFrame({"part": part, "island": island, "bins": [len(b) for b in best], "packing": [_packed(b) for b in best]})

    return run


def _placed(key, pieces: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
    pieces = pieces.sort_values("row").reset_index(drop=True)
    where = np.frombuffer(best["packing"].iloc[0], "<i4") if len(best) else np.zeros(0, dtype="<i4")
    offset = pieces["length"].groupby(where).cumsum() - pieces["length"]
    out = pieces[["doc_id", "piece", "start", "length", "ids_crc32"]]
    return out.assign(sequence_id=(int(key[0]) << 20) + where.astype(np.int64), offset=offset)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Places pieces (a written table of ``PIECE_SCHEMA``) in sequences of ``capacity``.

    A full piece is a sequence by itself.  Others are dealt evenly by ``row`` into parts of
    about ``PART_PIECES``; islands evolve packings of each part, pass their best two to the next
    island after each round, and the packing with the fewest sequences of all islands stays.
    A part costs at most one sequence more than its pieces need in a joint packing of parts.
    Sequence ids are any distinct numbers; offsets are gapless from 0.
    """
    short = pieces.filter(F.col("length") < capacity)
    parts = max(1, -(-short.count() // PART_PIECES))
    dealt = short.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    lengths = dealt.select("part", "row", "length", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    spark = pieces.sparkSession
    elites = spark.createDataFrame([], ELITE_SCHEMA)
    for number in range(ROUNDS):
        # Own and received elites; the next island gets copies.
        moved = elites.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        given = elites.unionByName(moved)
        evolved = lengths.groupBy("part", "island").cogroup(given.groupBy("part", "island"))
        elites = materialize(evolved.applyInPandas(_island(capacity, number), ELITE_SCHEMA))
    first = Window.partitionBy("part").orderBy("bins", "island", "packing")  # 2 x ISLANDS rows a part
    best = elites.withColumn("place", F.row_number().over(first)).filter("place = 1").select("part", "packing")
    placed = dealt.groupBy("part").cogroup(best.groupBy("part")).applyInPandas(_placed, PLACED)
    full = pieces.filter(F.col("length") >= capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return placed.unionByName(full)


def pack_documents(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """Pieces of ``df``'s texts with their places.

    A null text counts as empty and is a piece with just the end id.  Null ids and repeated
    rows are packed like any others.  Columns besides id and text are not carried.
    """
    return pack_pieces(materialize(cut_pieces(df, path, end_id, capacity, **columns)), capacity)
