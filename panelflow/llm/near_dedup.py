"""Near duplicates by a chosen-path set similarity join over word shingles.

Each distinct shingle set gets ``COORDINATES`` minwise tokens.  A tree deals the sets into
nodes by a few chosen coordinates; a node of more than ``NODE_ROWS`` sets is dealt again by
further coordinates chosen from the node's own number, smaller ones are compared
exhaustively.  Candidates are confirmed on full sets.  Independent trees repeat this; sets
that are connected already are not compared again, and only links that join components are
passed on, so a group of copies never becomes all of its pairs.

A node that stays large after ``LEVELS`` deals is compared with pivots in rounds, confirmed on
full sets, until every set of it is connected or has been a pivot, so it misses nothing.

A tree begins with ``ROOTS`` branches, and large nodes of the first level have ``BRANCHES``.
A pair of similarity ``s`` shares a node of a tree with probability ``1 - (1 - s) ** ROOTS``
where nodes are small; two trees of four roots miss it once in 3.9 million at 0.85 and once in
390,000 at 0.8.  Where nodes are large at every level the pair has to share four chosen tokens
one after another: both trees miss it once in 29,000 at 0.85 and once in 1,900 at 0.8.  These
are the numbers of four trees of two roots, which took twice as many jobs.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from panelflow.llm.tokens import slices
from panelflow.session import BROADCAST_ROW_LIMIT, arrow_rows, broadcast_if_small, materialize

COORDINATES = 128
TREES, ROOTS, BRANCHES = 2, 4, 2
# Largest node that is compared exhaustively, and levels of dealing before the dense rule.
NODE_ROWS, LEVELS = 512, 3
# Sets of a dense node that all of its others are compared with, and how many unconnected
# sets a dense node may have to be compared with all at once.
PIVOTS, LOOSE = 8, 32
# Sketches this far below the threshold are not looked at: over four standard deviations.
MARGIN = 0.15
SALTS = 64
# Sets of a dense node that meet its pivots in one run, and shingles these have together.
PART_ROWS, PART_ITEMS = 4096, 2_000_000
# Shingles of all pivots that are sent to every task: 8 MB.
PIVOT_ITEMS = 1_000_000
# Words whose hashes a Python worker remembers; others are hashed each time. Rows with texts or sets that are read at once.
HELD_WORDS, TEXT_ROWS = 100_000, 1000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_rng = np.random.default_rng(20)
_XOR = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_MULTIPLY = _rng.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < HELD_WORDS and len(word) <= 40:
            self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``words`` words; a shorter text is one run."""
    found = (text or b"").translate(_LOWER).split()
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    size = min(words, len(h))
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total = _mixed(total + h[k : k + len(total)])
    return np.unique(total)


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise tokens of non-empty sets, ``len(sets) x COORDINATES``."""
    flat = np.concatenate(sets)
    begins = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), dtype="<u4")
    for c in range(COORDINATES):
        out[:, c] = np.minimum.reduceat((flat ^ _XOR[c]) * _MULTIPLY[c], begins) >> np.uint64(32)
    return out


def shingled(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(id, n, key, sketch, items)``: key names the set; null for an empty set."""
    slim = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))

    def run(batches):
        hashes = _WordHashes()
        for batch in (b.slice(a, TEXT_ROWS) for b in batches for a in range(0, b.num_rows, TEXT_ROWS)):
            texts = batch.column(1).to_pylist()
            for s in slices(texts, 1_000_000):
                sets = [shingle_set(t, words, hashes) for t in texts[s]]
                full = [i for i, x in enumerate(sets) if len(x)]
                sketches: list[bytes | None] = [None] * len(sets)
                if full:
                    for i, row in zip(full, _sketches([sets[i] for i in full])):
                        sketches[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(s.start, s.stop - s.start),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
                        pa.array(sketches, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets).view(np.int64))),
                    ],
                    names=["id", "n", "key", "sketch", "items"],
                )

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, n long, key binary, sketch binary, items array<long>")


def _runs(batches, column: str) -> Iterator[pa.Table]:
    """Rows of equal ``column`` out of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            if held and held[-1].column(column)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, COORDINATES)


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _begun(comps: list) -> _Union:
    """Sets of one component are connected already."""
    union, first = _Union(len(comps)), {}
    for i, c in enumerate(comps):
        union.join(first.setdefault(c, i), i)
    return union


def _clusters(rows: DataFrame, floor: float) -> DataFrame:
    """Sets of each node whose sketches hang together; other sets of the node have no link there."""

    def run(batches):
        for node in _runs(batches, "node"):
            s = _matrix(node["sketch"])
            union, linked = _Union(len(s)), np.zeros(len(s), dtype=bool)
            least = floor * COORDINATES
            for i in range(len(s) - 1):
                for j in (np.flatnonzero((s[i + 1 :] == s[i]).sum(axis=1) >= least) + i + 1).tolist():
                    union.join(i, j)
                    linked[i] = linked[j] = True
            if linked.any():
                keep = np.flatnonzero(linked)
                number = node["node"][0].as_py()
                part = node.take(pa.array(keep))
                yield from pa.table(
                    {"cluster": [f"{number}/{union.root(i)}" for i in keep.tolist()], "key": part["key"], "comp": part["comp"]}
                ).to_batches()

    ordered = rows.repartition("node").sortWithinPartitions("node").select("node", "key", "comp", "sketch")
    found = ordered.mapInArrow(run, "cluster string, key binary, comp binary")
    return found


def _released(df: DataFrame) -> None:
    """Let Spark drop broadcasts and shuffle files of plans that nothing refers to any more.

    It does so when the driver collects garbage, which a driver with room may not do for long.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def _enough(shared, a, b, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def _confirmed(clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components, confirmed on the full sets of each cluster."""

    def run(batches):
        for cluster in _runs(batches, "cluster"):
            items = [np.asarray(x) for x in cluster["items"].to_numpy()]
            comps = cluster["comp"].to_pylist()
            union, sizes = _begun(comps), np.array([len(x) for x in items])
            values, places = np.unique(np.concatenate(items), return_inverse=True)
            ends = np.cumsum(sizes)
            links = []
            for i in range(len(items) - 1):
                mark = np.zeros(len(values), dtype=bool)
                mark[places[ends[i] - sizes[i] : ends[i]]] = True
                if all(union.root(j) == union.root(i) for j in range(i + 1, len(items))):
                    continue
                shared = np.add.reduceat(mark[places], ends - sizes)
                for j in (np.flatnonzero(_enough(shared, sizes[i], sizes, percent))).tolist():
                    if j > i and union.join(i, j):
                        links.append((comps[i], comps[j]))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    held = clusters.join(sets, "key").repartition("cluster").sortWithinPartitions("cluster").select("cluster", "comp", "items")
    return held.mapInArrow(run, "a binary, b binary")


def _near_pivots(rows: DataFrame, pivots: DataFrame, floor: float) -> DataFrame:
    """Each dense node's sets with those of its pivots that look alike and are not connected with them.

    A set is one row for a node, however many pivots it has there.  A node is dealt into parts of about ``PART_ROWS`` sets that each get all its pivots, so a
    set is read once however many pivots there are, and no node lands in one task.
    """

    def run(batches):
        deal, pivots = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            deals = batch.column("deal").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(deals[1:] != deals[:-1]) + 1).tolist(), len(deals)]
            for a, b in zip(cuts, cuts[1:]):
                if deals[a] != deal:
                    deal, pivots = deals[a], []
                here = batch.slice(a, b - a)
                first = int(here.column("pivot").to_numpy(zero_copy_only=False).sum())  # pivots come first
                head, rest = here.slice(0, first), here.slice(first)
                sketches = head.column("sketch").to_pylist()
                pivots += zip(head.column("key").to_pylist(), head.column("comp").to_pylist(), sketches)
                if not rest.num_rows or not pivots:
                    continue
                s, comps = _matrix(rest.column("sketch")), rest.column("comp")
                met = np.empty((rest.num_rows, len(pivots)), dtype=bool)
                for k, (_, comp, sketch) in enumerate(pivots):
                    apart = pc.not_equal(comps, pa.scalar(comp, pa.binary())).to_numpy(zero_copy_only=False)
                    met[:, k] = apart & ((s == np.frombuffer(sketch, "<u4")).sum(axis=1) >= floor * COORDINATES)
                if not met.any():
                    continue
                some = np.flatnonzero(met.any(axis=1))
                which = pa.array(np.nonzero(met)[1])
                ends = pa.array(np.cumsum([0, *met[some].sum(axis=1)]), pa.int32())
                keys, owns = (pa.array(x, pa.binary()).take(which) for x in list(zip(*pivots))[:2])
                lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([keys, owns], names=["p_key", "p_comp"]))
                found = rest.select(["key", "comp"]).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([*found.columns, lists], names=["key", "comp", "pivots"])

    parts = F.ceil(F.col("all") / PART_ROWS).cast("int")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), parts).cast("int")).withColumn("pivot", F.lit(False))
    spread = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("pivot", F.lit(True))
    columns = [F.concat_ws("/", F.col("node").cast("string"), F.col("part").cast("string")).alias("deal"), "pivot", "key", "comp", "sketch"]
    both = dealt.select(*columns).unionByName(spread.select(*columns))
    ordered = both.repartition("deal").sortWithinPartitions("deal", F.desc("pivot"))
    return ordered.mapInArrow(run, "key binary, comp binary, pivots array<struct<p_key: binary, p_comp: binary>>")


def _dense_links(rows: DataFrame, sets: DataFrame, tree: int, floor: float, percent: int) -> DataFrame:
    """Links in large nodes of every level: to pivots, or to all loose sets where these are few.

    A set is loose if it is outside the node's largest component.  Sets within one component
    need no comparison, so ``loose x all`` settles a node; before that, each tree takes other
    pivots, which connect most of a group of copies.  Work is linear in the node's rows.  What
    this leaves open is dealt on to the next level, and at the last one left to ``_settled``.
    """
    parts = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("n"))
    sums = parts.groupBy("node").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"))
    marked = rows.join(broadcast_if_small(sums), "node")
    loose = F.col("all") - F.col("top.n") <= LOOSE
    settled = marked.filter(loose & (F.col("comp") != F.col("top.comp"))).select("node", "all", "key", "comp", "sketch")
    order = F.struct(F.xxhash64("key", F.lit(tree)).alias("h"), "key", "comp", "sketch")
    chosen = marked.filter(~loose).groupBy("node", "all", F.pmod(F.xxhash64("key", F.lit(tree), F.lit("p")), F.lit(PIVOTS)).alias("seat"))
    drawn = chosen.agg(F.min(order).alias("p")).select("node", "all", F.col("p.key").alias("key"), F.col("p.comp").alias("comp"), F.col("p.sketch").alias("sketch"))
    pivots = materialize(settled.unionByName(drawn))
    # A set meets the same pivots in several nodes.
    met = _near_pivots(marked, pivots, floor).groupBy("key", "comp").agg(F.array_distinct(F.flatten(F.collect_list("pivots"))).alias("pivots"))
    pairs = materialize(met.select("key", "comp", F.inline("pivots")))
    pivot_sets = sets.join(broadcast_if_small(pairs.select(F.col("p_key").alias("key")).distinct()), "key", "left_semi")
    pivot_sets = materialize(pivot_sets.select(F.col("key").alias("p_key"), F.col("items").alias("p_items")))
    weight = pivot_sets.agg(F.coalesce(F.sum(F.size("p_items").cast("long") + 8), F.lit(0))).first()[0]
    held = F.broadcast(pivot_sets) if weight <= PIVOT_ITEMS else pivot_sets
    own = pairs.join(sets.select("key", "items"), "key").join(held, "p_key")
    shared = F.size(F.array_intersect("items", "p_items"))
    return own.filter(_enough(shared, F.size("items"), F.size("p_items"), percent)).select(F.col("comp").alias("a"), F.col("p_comp").alias("b"))


class _Part:
    """Some sets of a node, which pivots come past one by one."""

    def __init__(self, held: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(held)
        self.sketches = _matrix(rows["sketch"])
        items = [np.asarray(x) for x in rows["items"].to_numpy()]
        self.sizes = np.array([len(x) for x in items])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.values, self.places = np.unique(np.concatenate(items), return_inverse=True)
        self.codes: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.union = _Union(0)
        self.now = np.array([self._code(c) for c in rows["comp"].to_pylist()])

    def _code(self, comp: bytes) -> int:
        code = self.codes.setdefault(comp, len(self.codes))
        if code == len(self.names):
            self.names.append(comp)
            self.union.up.append(code)
        return self.union.root(code)

    def links(self, comp: bytes, sketch: bytes, items: np.ndarray, floor: float, percent: int) -> list[bytes]:
        """Components that the pivot is the first to connect with its own."""
        own = self._code(comp)
        alike = (self.now != own) & ((self.sketches == np.frombuffer(sketch, "<u4")).sum(axis=1) >= floor * COORDINATES)
        if not alike.any():
            return []
        at = np.minimum(np.searchsorted(self.values, items), len(self.values) - 1)
        mark = np.zeros(len(self.values), dtype=bool)
        mark[at[self.values[at] == items]] = True
        shared = np.add.reduceat(mark[self.places], self.starts, dtype=np.int64)
        others = np.unique(self.now[alike & _enough(shared, self.sizes, len(items), percent)])
        for code in others.tolist():
            self.union.join(own, code)
        self.now[np.isin(self.now, [*others, own])] = self.union.root(own)
        return [self.names[c] for c in others.tolist()]


def _pivot_links(rows: DataFrame, floor: float, percent: int) -> DataFrame:
    """Links of each node's sets with its pivots; at most one for each set or pivot of a part.

    ``rows(node, parts, key, comp, sketch, items, pivot)``: parts is the number of parts that
    the node is dealt into.  Each part gets all pivots, one after another.
    """

    def run(batches):
        deal, held, part = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            deals = batch.column("deal").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(deals[1:] != deals[:-1]) + 1).tolist(), len(deals)]
            for a, b in zip(cuts, cuts[1:]):
                if deals[a] != deal:
                    deal, held, part = deals[a], [], None
                here = batch.slice(a, b - a)
                first = len(here) - int(here.column("meets").to_numpy(zero_copy_only=False).sum())  # pivots come last
                if first:
                    held.append(here.slice(0, first))
                pivots = here.slice(first)
                if not held or not len(pivots):
                    continue
                part = part or _Part(held)
                found = []
                columns = [pivots.column("comp").to_pylist(), pivots.column("sketch").to_pylist(), pivots.column("items").to_numpy(zero_copy_only=False)]
                for comp, sketch, items in zip(*columns):
                    found += [(comp, other) for other in part.links(comp, sketch, np.asarray(items), floor, percent)]
                if found:
                    x, y = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["a", "b"])

    at = F.pmod(F.xxhash64("key", F.lit("part")), "parts").cast("int")
    dealt = rows.withColumn("part", at).withColumn("meets", F.lit(False))
    spread = rows.filter("pivot").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("meets", F.lit(True))
    columns = [F.concat_ws("/", F.col("node").cast("string"), F.col("part").cast("string")).alias("deal"), "meets", "comp", "sketch", "items"]
    both = dealt.select(*columns).unionByName(spread.select(*columns))
    return both.repartition("deal").sortWithinPartitions("deal", "meets").mapInArrow(run, "a binary, b binary")


def _relabelled(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``rows`` with the components ``joined(key, comp)`` that theirs are part of by now."""
    to = joined.select(F.col("key").alias("comp"), F.col("comp").alias("to"))
    return rows.join(broadcast_if_small(to), "comp", "left").withColumn("comp", F.coalesce("to", "comp")).drop("to")


def _with_joined(comps: DataFrame | None, joined: DataFrame) -> DataFrame:
    """``comps(key, comp)`` after ``joined``, components of its components and of keys it does not hold."""
    if comps is None:
        return joined
    further = joined.join(broadcast_if_small(comps.select("key")), "key", "left_anti")
    return _relabelled(comps, joined).select("key", "comp").unionByName(further)


def _settled(rows: DataFrame, sets: DataFrame, joined: DataFrame, tree: int, floor: float, percent: int) -> list[DataFrame]:
    """What is connected further in nodes that stay large, once ``joined`` by the tree's other links: a table a round.

    In each round of a node, loose sets that have not been pivots yet, those next in the order
    of a hash, meet all sets of the node.  It ends when none is left, so two sets that are still
    apart have been compared.  Rounds grow, and are linear in the node's rows; a node of copies
    is connected after few, one of different sets takes ``loose x all`` comparisons of sketches.
    """
    rows = _dealt(_relabelled(rows, joined)).select("node", "key", "comp", "sketch")
    sizes = sets.select("key", F.size("items").cast("long").alias("n_items"))
    turn = F.pmod(F.xxhash64("key", "node", F.lit(tree)), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.join(sizes, "key").withColumns({"turn": turn, "met": F.lit(0.0)})
    many, own, rounds = NODE_ROWS, None, []
    while True:
        rows = materialize(rows)
        waits = F.sum((F.col("turn") >= F.col("met")).cast("long"))
        comps = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("n"), waits.alias("waits"), F.sum("n_items").alias("items"))
        nodes = comps.groupBy("node").agg(
            F.max(F.struct("n", "comp", "waits")).alias("top"), F.sum("n").alias("all"), F.sum("waits").alias("waits"), F.sum("items").alias("items")
        )
        nodes = nodes.withColumn("left", F.col("waits") - F.col("top.waits")).filter("left > 0")
        parts = F.ceil(F.greatest(F.col("all") / PART_ROWS, F.col("items") / PART_ITEMS)).cast("int")
        nodes = materialize(nodes.select("node", "left", F.col("top.comp").alias("top"), parts.alias("parts")))
        if nodes.isEmpty():
            return rounds
        to = F.when(F.col("left") <= many, F.lit(1.0)).otherwise(F.col("met") + (1 - F.col("met")) * many / F.col("left"))
        rows = rows.join(broadcast_if_small(nodes), "node").withColumn("to", to)
        pivot = (F.col("comp") != F.col("top")) & (F.col("turn") >= F.col("met")) & (F.col("turn") < F.col("to"))
        if own is None:
            own = materialize(sets.join(broadcast_if_small(rows.select("key").distinct()), "key", "left_semi").select("key", "items"))
        chosen = rows.withColumn("pivot", pivot).select("node", "parts", "key", "comp", "sketch", "pivot").join(own, "key")
        rounds.append(materialize(components(_pivot_links(chosen, floor, percent))))
        rows = _relabelled(rows.select("node", "key", "comp", "sketch", "n_items", "turn", F.col("to").alias("met")), rounds[-1])
        many = min(8 * many, PART_ROWS)


def _coordinate(number: Column) -> Column:
    """Bytes of a chosen minwise token."""
    return F.substring(F.col("sketch"), 4 * number + 1, F.lit(4))


def _dealt(rows: DataFrame) -> DataFrame:
    """Only nodes of at least two sets that are not connected, with their size."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    worth = sizes.filter("rows > 1 AND low <> high").select("node", "rows")
    return rows.join(broadcast_if_small(materialize(worth)), "node")


def components(links: DataFrame) -> DataFrame:
    """``(key, comp)`` of every key in ``links(a, b)``; comp is the least key that is connected.

    Large-star and small-star steps in turn until nothing changes.  While there are few edges, the least
    neighbours are broadcast, and both steps are one job that shuffles for its sums alone.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = state(edges)
    while before[0]:
        few = 2 * before[0] <= BROADCAST_ROW_LIMIT
        held = F.broadcast if few else lambda df: df
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # As many rows as edges, so equal ones may wait for the next distinct().
        large = both.filter("b > a").join(held(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large if few else materialize(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(held(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("key"), F.col("b").alias("comp")).unionByName(
        edges.select(F.col("b").alias("key"), F.col("b").alias("comp")).distinct()
    )


def _tree_comps(reps: DataFrame, sets: DataFrame, comps: DataFrame | None, tree: int, percent: int) -> DataFrame:
    """``comps(key, comp)`` after the links of one tree; each link goes into components once."""
    floor = percent / 100 - MARGIN
    rows = reps.select("key", "sketch")
    if comps is None:
        rows = rows.withColumn("comp", F.col("key"))
    else:
        rows = rows.join(broadcast_if_small(comps), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    first = [tree * ROOTS + b for b in range(ROOTS)]
    roots = F.array(*[F.xxhash64(F.lit(c), _coordinate(F.lit(c))) for c in first])
    rows = materialize(_dealt(rows.withColumn("node", F.explode(roots))))
    small, found = [rows.filter(F.col("rows") <= NODE_ROWS)], []
    large = rows.filter(F.col("rows") > NODE_ROWS).drop("rows")
    dense = []
    for level in range(LEVELS):
        if large.isEmpty():
            break
        chosen = [F.pmod(F.xxhash64("node", F.lit(level), F.lit(b)), F.lit(COORDINATES)).cast("int") for b in range(BRANCHES if not level else 1)]
        deeper = large.withColumn("node", F.explode(F.array(*[F.xxhash64("node", c, _coordinate(c)) for c in chosen])))
        deeper = materialize(_dealt(deeper))
        dense.append(large)
        small.append(deeper.filter(F.col("rows") <= NODE_ROWS))
        large = deeper.filter(F.col("rows") > NODE_ROWS).drop("rows")
    leaves = small[0]
    for more in small[1:]:
        leaves = leaves.unionByName(more)
    clusters = materialize(_clusters(leaves, floor))
    needed = broadcast_if_small(clusters.select("key").distinct())
    found.append(_confirmed(clusters, sets.join(needed, "key", "left_semi"), percent))
    dense.append(large)
    held = dense[0]
    for more in dense[1:]:
        held = held.unionByName(more)
    if not held.isEmpty():
        found.append(_dense_links(held, sets, tree, floor, percent))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    joined = materialize(components(links))
    comps = _with_joined(comps, joined)
    if not large.isEmpty():
        for further in _settled(large, sets, joined, tree, floor, percent):
            comps = _with_joined(comps, further)
    return materialize(comps)


def _connected(df: DataFrame, id_col: str, text_col: str, words: int, percent: int, trees: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """All rows with their sets, distinct sets, and the components of these; all written."""
    table = materialize(shingled(df, id_col, text_col, words))
    named = table.filter("key IS NOT NULL")
    reps = materialize(named.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.max("sketch").alias("sketch")))
    # One set of each key: equal keys have equal sets, so any row with the smallest id will do.
    sets = named.select("key", "id", "items")
    repeated = reps.filter("copies > 1").select("key", F.col("id").alias("first_id"))
    comps = None
    chosen = sets.join(broadcast_if_small(repeated), "key", "left")
    chosen = chosen.filter(F.col("first_id").isNull() | F.col("id").eqNullSafe(F.col("first_id"))).select("key", "items")
    for tree in range(trees):
        comps = _tree_comps(reps, chosen, comps, tree, percent)
        _released(df)
    return table, reps, comps


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, trees: int = TREES
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` of every row.

    Rows are linked if their sets of ``words``-word shingles have ``100 * shared >= percent *
    union``; ``component_id`` is the smallest id reachable over links, ``kept`` marks it.  Words
    are runs of other than ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; a text of fewer words is one
    shingle.  A null text or one without words has an empty set and is linked with nothing.
    Rows of equal sets are one set from the start.  A null id is a component's id only where
    all its ids are null; rows that repeat an id are flagged alike.
    """
    with arrow_rows(df.sparkSession, TEXT_ROWS):
        table, reps, comps = _connected(df, id_col, text_col, words, percent, trees)
    groups = reps.join(broadcast_if_small(comps), "key", "left").select("key", "id", "copies", F.coalesce("comp", "key").alias("comp"), F.col("comp").isNotNull().alias("linked"))
    several = groups.filter("linked OR copies > 1")
    least = several.groupBy("comp").agg(F.min("id").alias("component_id"))
    answer = materialize(several.join(broadcast_if_small(least), "comp").select("key", "component_id", F.lit(True).alias("several")))
    rows = table.select("id", "n", "key")
    small = broadcast_if_small(answer)
    if small is not answer:
        out = rows.join(small, "key", "left")
    else:
        spread = answer.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(spread, ["key", "salt"], "left")
    component = F.when(F.col("several"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with one row of each group of near duplicates, that of the smallest id; same columns.

    Rows are told apart by id and text: where an id occurs with several texts, each is judged for itself,
    and of one group's rows with the smallest id the one of the smallest digest stays.  Rows that repeat id and
    text of one that stays, rows without words and rows without id all stay.  Columns may have any names.
    """
    free = "_gone"
    while free in {c.lower() for c in df.columns}:
        free += "_"
    row_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").cast("binary")
    digest = F.unhex(F.md5(text))
    # An absent id sorts last, so that it never names a group with other ids.
    named = df.select(F.struct(row_id.isNull().alias("absent"), row_id.alias("id"), digest.alias("digest")).alias("row"), text.alias("text"))
    gone = near_duplicates(named, "row", "text", words, percent).filter("NOT kept AND row.id IS NOT NULL")
    gone = materialize(gone.select(F.struct("row.id", "row.digest").alias(free)).distinct())
    same = (row_id == F.col(free)["id"]) & (digest == F.col(free)["digest"])
    return df.join(broadcast_if_small(gone), same, "left_anti")
