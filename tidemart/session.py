"""Spark session settings and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Window state of many symbols outgrows the heap; RocksDB keeps it on disk, and holds the several states of a processor.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    STATE_STORE: ROCKSDB,
}


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, adaptive execution and no web page."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, also in a session that ``build_session`` did not make.

    A stream takes the settings as they are when it starts, so the session's
    own are back as soon as it has.
    """
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary
    folder of this machine, and remembers it for the rest of the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    remembered = spark.conf.get("tidemart.local.folder", None)
    if remembered is None:
        remembered = tempfile.mkdtemp(prefix="tidemart-")
        spark.conf.set("tidemart.local.folder", remembered)
    return remembered


def work_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/tidemart/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the work folder that nothing has used yet."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Rows of a shuffle that one task takes, where their number is known.
ROWS_PER_TASK = 400_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """So many shuffle partitions that a task's share does not grow with ``rows``; never fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))


@contextmanager
def shuffles_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside shuffle into ``tasks_for`` that many rows; adaptive execution joins small partitions."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, tasks_for(spark, rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Spark deletes a job's shuffle files when it ends, instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Each query run inside deletes its shuffle files as soon as it has ended."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


#: Rows that a Parquet reader holds at a time, and how many of long texts.
READER_ROWS, TEXT_ROWS = "spark.sql.parquet.columnarReaderBatchSize", 256


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside read Parquet by ``TEXT_ROWS`` rows, as a batch of thousands of long texts fills the heap."""
    before = spark.conf.get(READER_ROWS)
    spark.conf.set(READER_ROWS, min(int(before), TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(READER_ROWS, before)


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    files, place = _place(spark, path)
    return sorted(c.getPath().getName() for c in files.listStatus(place)) if files.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def clear_work(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no result needs them."""
    delete(spark, work_folder(spark))


#: The codec of Parquet files that have to be small.
SMALLEST = "zstd"


def unpin(pinned: DataFrame) -> None:
    """Delete what ``pin`` has written, once nothing reads it any more."""
    spark = pinned.sparkSession
    for path in sorted({file.rpartition("/")[0] for file in pinned.inputFiles()}):
        if "/tidemart/" not in path:
            raise ValueError(f"not in a work folder: {path}")
        delete(spark, path)


def pin(df: DataFrame, label: str = "pin", codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where several passes read the same costly result, or where a small
    aggregate is joined back: a written table has a known size, so Spark
    broadcasts it only if it really is small. The table is plain Parquet, so
    later passes prune columns, and a lost executor costs a re-read of files
    instead of a re-run of everything upstream. ``codec`` is the session's if
    not given; ``SMALLEST`` where the table is large and lies beside others.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
