"""File sources and sinks: panel CSV, raw pages with manifest, feeds, reports."""

from __future__ import annotations

import os
from collections.abc import Sequence
from itertools import count, groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelflow import schemas
from panelflow.session import arrow_rows, materialize

# Stored pages of one folder: folders are listed in parallel, the files of one by one task.
PAGES_PER_FOLDER = 1000

# Bytes of small files that one task reads.
TASK_BYTES = 16 << 20

# Names of files that Hadoop's codecs unpack.
PACKED = ("bz2", "deflate", "gz", "lz4", "snappy", "zst")


def read_panel_csv(spark: SparkSession, path: str | list[str], schema: str = schemas.PANEL) -> DataFrame:
    """Header CSV with a declared schema; the file name is kept as provenance.

    The header is checked against the schema, so a file with other columns fails.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )


def write_panel(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Partitioned sink in place of one file per country.

    The rebalance hint gathers a partition value's rows into few files and lets the
    runtime split a value that holds a large share of all rows.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        sort_by = [*partition_by, *sort_by]
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metrics, metadata and reports as JSON lines."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Fetch metadata records: articles, then fallback pages.

    ``lines=False`` reads the single-document manifest; ``lines=True`` reads one record
    per line, the layout for crawls whose manifest should be split over tasks.
    """
    if lines:
        return spark.read.schema(schemas.PAGE_RECORD).json(path)
    document = spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path)
    both = F.concat(
        F.coalesce("articles", F.array()), F.coalesce("fallback_pages", F.array())
    )
    return document.select(F.explode(both).alias("page")).select("page.*")


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """Where Python finds ``path``; ``None`` if it is in a store that only Spark writes to."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return at.toUri().getPath() if store.getUri().getScheme() == "file" else None


def write_raw_pages(pages: DataFrame, path: str) -> DataFrame:
    """Pages (``page_id``, ``html``) stored one per file, two levels below ``path``, as a crawler
    leaves them; gives ``page_id`` and ``html_path`` of every file.

    Every page ends with one line break; rows of one id share a file if they come to one task.
    In a mounted folder the tasks make the files themselves, since Hadoop's local file system
    starts a process for each permission it sets.  A file gets its name when it is whole, so a
    task that runs again replaces what it left.
    """
    spark = pages.sparkSession
    folder = _local_folder(spark, path)
    if folder is None:
        # One partition value per page gives one file per page.
        named = pages.select(F.col("html").alias("value"), F.col("page_id").alias("page"))
        named.write.partitionBy("page").text(path, lineSep="\n")
        return spark.read.text(path, wholetext=True).select(
            F.col("page").alias("page_id"), F.col("_metadata.file_path").alias("html_path")
        )

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        pages = groupby(rows, itemgetter(0))
        for k in count():
            below, stored = f"{task.partitionId():05d}-{k:05d}", []
            for page_id, same in islice(pages, PAGES_PER_FOLDER):
                if not stored:
                    os.makedirs(f"{folder}/{below}", exist_ok=True)
                name = f"{page_id}.html"
                unfinished = f"{folder}/{below}/.{name}.{task.taskAttemptId()}"
                with open(unfinished, "wb") as file:
                    for _, html in same:
                        file.write((html or b"") + b"\n")
                os.replace(unfinished, f"{folder}/{below}/{name}")
                stored.append((page_id, f"{path}/{below}/{name}"))
            if not stored:
                return
            ids, paths = zip(*stored)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.string())], names=["page_id", "html_path"])

    slim = pages.select(F.col("page_id").cast("long"), F.col("html").cast("binary")).sortWithinPartitions("page_id")
    with arrow_rows(spark, 1000):
        return materialize(slim.mapInArrow(run, "page_id long, html_path string"))


def _path_end(path: Column, depth: int) -> Column:
    return F.substring_index(path, "/", -depth)


def _tasks(files: DataFrame) -> int:
    """Tasks for many small files by their bytes: Spark counts 4 MB for each, so 32 files make a task."""
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(4 * files.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def read_raw_pages(
    spark: SparkSession, html_glob: str, manifest: DataFrame, depth: int = 1
) -> DataFrame:
    """Manifest records joined to their stored HTML; records without a file are skipped.

    Manifest paths may be relative, so the last ``depth`` path segments are compared.  Files
    come as bytes, since the text reader copies the Hadoop settings for each of them; only
    those that it unpacks are left to it.
    """
    path = F.col("_metadata.file_path")
    stored = spark.read.format("binaryFile").load(html_glob)
    packed = path.rlike(rf"\.({'|'.join(PACKED)})$")
    plain = stored.filter(~packed).coalesce(_tasks(stored))
    files = plain.select(F.col("content").cast("string").alias("html"), _path_end(path, depth).alias("_end"))
    # Spark leaves out files by their path when it plans, so this reads none.
    if stored.filter(packed).rdd.getNumPartitions():
        unpacked = spark.read.text(html_glob, wholetext=True).filter(packed)
        files = files.unionAll(unpacked.select("value", _path_end(path, depth)))
    named = manifest.withColumn("_end", _path_end(F.col("html_path"), depth))
    return named.join(files, "_end").drop("_end")


_RSS = (
    "title STRING, item ARRAY<STRUCT<title: STRING, link: STRING, pubDate: STRING>>"
)
_ATOM_LINK = "STRUCT<_rel: STRING, _type: STRING, _href: STRING>"
_ATOM = (
    "title STRING, entry ARRAY<STRUCT<title: STRING, "
    f"link: ARRAY<{_ATOM_LINK}>, published: STRING, updated: STRING>>"
)


def _utc(text: Column) -> Column:
    """RFC 822 or ISO time stamp with offset as UTC wall time."""
    bare = F.regexp_replace(text, r"^[A-Za-z]{3,9},\s*", "")
    bare = F.regexp_replace(bare, r"\b(GMT|UTC|UT|Z)$", "+0000")
    instant = F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss xx")),
        F.try_to_timestamp(text),
    )
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def read_feed_entries(
    spark: SparkSession, path: str, dialect: str = "rss", feed_name: Column | None = None
) -> DataFrame:
    """Feed entries with their position in the feed (1 = first); one feed document per file.

    ``feed_name`` is the file stem unless given (a partition column of ``path``, say).  RSS
    gives ``link``; Atom gives ``links``.
    """
    rss = dialect == "rss"
    channels = (
        spark.read.format("xml")
        .option("rowTag", "channel" if rss else "feed")
        .schema(_RSS if rss else _ATOM)
        .load(path)
    )
    if feed_name is None:
        feed_name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]+$", "")
    entries = channels.select(
        feed_name.alias("feed_name"),
        F.posexplode("item" if rss else "entry").alias("pos", "e"),
    )
    if rss:
        fields = [
            F.trim("e.link").alias("link"),
            F.lit(None).cast(schemas.FEED_LINKS).alias("links"),
            _utc(F.trim("e.pubDate")).alias("published"),
            F.lit(None).cast("timestamp_ntz").alias("updated"),
        ]
    else:
        fields = [
            F.lit(None).cast("string").alias("link"),
            F.col("e.link").cast(schemas.FEED_LINKS).alias("links"),
            _utc(F.trim("e.published")).alias("published"),
            _utc(F.trim("e.updated")).alias("updated"),
        ]
    return entries.select(
        "feed_name",
        (F.col("pos") + 1).alias("entry_rank"),
        F.coalesce(F.trim("e.title"), F.lit("Untitled")).alias("title"),
        *fields,
    )
