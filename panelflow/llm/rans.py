"""Token ids in files of static range asymmetric numeral system (rANS) blocks.

A folder holds ``table`` (Parquet: id, freq; the frequencies sum to a power of two) shared by
all blocks, and ``blocks``: files of blocks one after another, documents in ascending id order
within and across the files by name.  A block is

    "RNS1", payload length (u64), CRC-32 of the payload (u32), payload, one line feed

and its payload, little endian,

    documents u32, tokens u64, lanes u32, table bits u8, steps per checkpoint u32,
    checkpoints u32, words u64, CRC-32 of the table u32, length of the document table u32,
    document table (zlib: null flag u8, id i64 and length u64 of each document),
    checkpoints (words before it u64, states of all lanes u64), words u32.

Lane ``j`` codes tokens ``j, j + lanes, ...``; all lanes draw 32-bit words from one stream in
lane order.  Decoding may begin at any checkpoint; ``read_ids`` still reads each block
whole, and each file in one task.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from panelflow.llm.tokens import encoder, slices
from panelflow.session import materialize

MAGIC = b"RNS1"
OUTER, INNER = struct.Struct("<4sQI"), struct.Struct("<IQIBIIQII")
LOW = np.uint64(1 << 31)
LANES, STEPS, BLOCK_TOKENS = 2048, 64, 1 << 20
# Bound of a file: blocks are about 1.5 MB.
BLOCKS_PER_FILE = 16


class Table:
    """Frequencies of ids scaled to ``1 << bits``; every id that occurs keeps at least 1."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.bits = int(self.freq.sum()).bit_length() - 1
        self.begin = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        present = int((counts > 0).sum())
        bits = max(16, (max(present, 1) - 1).bit_length() + 2)
        whole = 1 << bits
        scaled = counts.astype(np.float64) * ((whole - present) / max(int(counts.sum()), 1))
        freq = np.where(counts > 0, 1 + np.floor(scaled), 0).astype(np.int64)
        if not present:
            freq = np.ones(1, dtype=np.int64)
        freq[int(np.argmax(freq))] += whole - int(freq.sum())
        return cls(freq)


def encode_block(doc_ids: list, lengths: list[int], ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = min(LANES, max(1, n // 64))
    steps = -(-n // lanes)
    bits, shift = np.uint64(table.bits), np.uint64(63 - table.bits)
    freq, begin = table.freq[ids], table.begin[ids]
    states, low32, half = np.full(lanes, LOW, dtype=np.uint64), np.uint64(0xFFFFFFFF), np.uint64(32)
    parts: list[np.ndarray] = []
    written, points = 0, []
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes : (t + 1) * lanes], begin[t * lanes : (t + 1) * lanes]
        x = states[: len(f)]
        over = np.flatnonzero(x >= f << shift)
        if len(over):
            full = x[over]
            parts.append((full & low32).astype("<u4"))
            written += len(over)
            x[over] = full >> half
        q = x // f
        states[: len(f)] = (q << bits) + (x - q * f) + c
        if t % STEPS == 0:
            points.append((written, states.astype("<u8").tobytes()))
    docs = np.array([(i is None, i or 0, k) for i, k in zip(doc_ids, lengths)], dtype="<u1,<i8,<u8").tobytes()
    docs = zlib.compress(docs, 1)
    head = INNER.pack(len(doc_ids), n, lanes, table.bits, STEPS, len(points), written, table.crc, len(docs))
    tail = b"".join(struct.pack("<Q", written - w) + s for w, s in reversed(points))
    payload = head + docs + tail + b"".join(p.tobytes() for p in reversed(parts))
    return OUTER.pack(MAGIC, len(payload), zlib.crc32(payload)) + payload


def split_blocks(content: bytes) -> Iterator[bytes]:
    """Payloads of a file, each checked against its checksum."""
    at = 0
    while at < len(content):
        magic, size, crc = OUTER.unpack_from(content, at)
        payload = content[at + OUTER.size : at + OUTER.size + size]
        if magic != MAGIC or len(payload) != size or zlib.crc32(payload) != crc:
            raise ValueError(f"damaged block at byte {at}")
        yield payload
        at += OUTER.size + size + 1


def decode_block(payload: bytes, table: Table, first: int = 0, last: int | None = None):
    """``(null flags, document ids, lengths, ids)``; ids from checkpoint ``first`` to before ``last``."""
    n_docs, n, lanes, bits, every, n_points, n_words, crc, docs_len = INNER.unpack_from(payload)
    if crc != table.crc or bits != table.bits:
        raise ValueError("block belongs to another table")
    docs = np.frombuffer(zlib.decompress(payload[INNER.size : INNER.size + docs_len]), dtype="<u1,<i8,<u8")
    at, point = INNER.size + docs_len, 8 + 8 * lanes
    words = np.frombuffer(payload, "<u4", n_words, at + n_points * point).astype(np.uint64)
    last = n_points if last is None else min(last, n_points)
    begin, end = first * every, min(last * every, -(-n // lanes))
    out = np.zeros(max(0, min(end * lanes, n) - begin * lanes), dtype=np.uint32)
    if first < last:
        pos = struct.unpack_from("<Q", payload, at + first * point)[0]
        states = np.frombuffer(payload, "<u8", lanes, at + first * point + 8).astype(np.uint64)
        mask, shift, half = np.uint64((1 << bits) - 1), np.uint64(bits), np.uint64(32)
        for t in range(begin, end):
            x = states[: min(lanes, n - t * lanes)]
            slot = x & mask
            s = table.symbol[slot]
            x = table.freq[s] * (x >> shift) + slot - table.begin[s]
            under = np.flatnonzero(x < LOW)
            if len(under):
                x[under] = (x[under] << half) | words[pos : pos + len(under)]
                pos += len(under)
            states[: len(x)] = x
            out[(t - begin) * lanes : (t - begin) * lanes + len(x)] = s
    return docs["f0"].astype(bool), docs["f1"], docs["f2"].astype(np.int64), out


def tokenized(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, ids)``: ids of every whole text and ``end_id``, little endian and zstd-packed.

    A null text counts as empty.
    """

    def run(batches):
        enc = encoder(path)
        end, pack = np.array([end_id], dtype=enc.dtype).tobytes(), zstandard.ZstdCompressor(level=1)
        wide = enc.dtype.itemsize
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s in slices(texts):
                ids = [i + end for i in enc.encode(texts[s])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(s.start, s.stop - s.start),
                        pa.array([len(i) // wide for i in ids], pa.int64()),
                        pa.array([pack.compress(i) for i in ids], pa.binary()),
                        pa.array([wide] * len(ids), pa.int32()),
                    ],
                    names=["doc_id", "n", "ids", "width"],
                )

    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n long, ids binary, width int")


def _unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    for ids, width in zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist()):
        yield np.frombuffer(unpack.decompress(ids), f"<u{width}")


def id_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs; one row per id of the vocabulary comes to the driver."""

    def run(batches):
        total, held, size = np.zeros(0, dtype=np.int64), [], 0
        for batch in batches:
            for ids in _unpacked(batch):
                if len(ids) and int(ids.max()) >= len(total):
                    total = np.pad(total, (0, int(ids.max()) + 1 - len(total)))
                held.append(ids)
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    rows = tokens.select("ids", "width").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, dtype=np.int64)
    counts[found["id"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return counts


def write_ids(tokens: DataFrame, path: str) -> None:
    """Writes ``tokenized`` rows, which should be a written table, as a folder of rANS blocks.

    Rows are dealt by ranges of the id.  Null ids come first; rows that repeat an id stay
    side by side.
    """
    spark = tokens.sparkSession
    table = Table.of_counts(id_counts(tokens))
    freq = table.freq.astype(np.int64)
    used = np.flatnonzero(freq)
    spark.createDataFrame([(int(i), int(freq[i])) for i in used], "id long, freq long").coalesce(1).write.parquet(f"{path}/table")

    def run(batches):
        docs, lengths, held, total = [], [], [], 0
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), _unpacked(batch)):
                docs.append(doc)
                lengths.append(len(ids))
                held.append(ids)
                total += len(ids)
                if total >= BLOCK_TOKENS:
                    yield pa.RecordBatch.from_arrays([pa.array([encode_block(docs, lengths, np.concatenate(held), table)], pa.binary())], names=["block"])
                    docs, lengths, held, total = [], [], [], 0
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([encode_block(docs, lengths, np.concatenate(held), table)], pa.binary())], names=["block"])

    ordered = tokens.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n", "ids")
    blocks = ordered.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value"))
    blocks.write.option("lineSep", "\n").option("maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/table").toPandas()
    freq = np.zeros(int(rows["id"].max()) + 1, dtype=np.int64)
    freq[rows["id"].to_numpy()] = rows["freq"].to_numpy()
    return Table(freq)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(file, at, doc_id, n, ids)`` of a written folder: ids as little-endian u32, place in the file."""
    table = read_table(spark, path)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = 0
                for payload in split_blocks(content):
                    missing, docs, lengths, ids = decode_block(payload, table)
                    ends = np.cumsum(lengths)
                    raw = ids.astype("<u4").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(docs), pa.string()),
                            pa.array(at + ends - lengths, pa.int64()),
                            pa.array(docs, pa.int64(), mask=missing),
                            pa.array(lengths, pa.int64()),
                            pa.array([raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), lengths.tolist())], pa.binary()),
                        ],
                        names=["file", "at", "doc_id", "n", "ids"],
                    )
                    at += len(ids)

    files = spark.read.format("binaryFile").load(f"{path}/blocks").filter("length > 0").select("path", "content")
    return files.mapInArrow(run, "file string, at long, doc_id long, n long, ids binary")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of a written folder, ``start`` over all files."""
    docs = materialize(
        read_ids(spark, path).select("file", "at", "doc_id", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    )
    totals = docs.groupBy("file").agg(F.max(F.col("at") + F.col("n_tokens")).alias("total"))
    # One row per file of up to 16 million tokens.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return docs.join(base, "file").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
