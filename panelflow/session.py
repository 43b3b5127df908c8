"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows up to which a lookup side may be broadcast.  The rows concerned are two short
# strings or a string and a double, so this stays below ~100 MB per executor.
BROADCAST_ROW_LIMIT = 500_000


def local_session(app: str = "panelflow", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter owns these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may go without that setting: a folder of this machine is made then.
    On a cluster executors would each write to a disk of their own, so it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="panelflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/panelflow-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a written table in the shared folder.

    Parquet rather than ``checkpoint()``: later reads prune columns and carry size
    statistics, and the files survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df``, written, with a number per row, so that rows can be told apart without a key.

    Numbers are fixed by the write; a column computed again might come out differently.
    """
    return materialize(df.withColumn(name, F.monotonically_increasing_id()))


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread an input of fewer partitions than cores before per-row text work.

    Large inputs have many splits and are left alone; one unsplittable file is not
    allowed to keep the other cores idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def rows_up_to(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> int | None:
    """Row count if at most ``max_rows``, else ``None``; reads no more rows than that."""
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks of jobs that run inside get at most ``rows`` rows at once, for rows of long arrays or texts.

    Spark's 10,000 of them are held by the JVM and by Python at the same time, in every task.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own, now = spark.conf.get(name, None), int(spark.conf.get(name))
    spark.conf.set(name, min(rows, now) if now > 0 else rows)
    try:
        yield
    finally:
        spark.conf.unset(name) if own is None else spark.conf.set(name, own)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only after counting it; otherwise leave the join to shuffle."""
    return df if rows_up_to(df, max_rows) is None else F.broadcast(df)
