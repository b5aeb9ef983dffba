"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


READ_KEY = "spark.sql.parquet.columnarReaderBatchSize"
BATCH_KEY, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder, through Spark's own reader.

    Documents are large rows, so that Spark's default batch of 10,000 is some 40 MB in the JVM and again in Python: if the
    session still has that default, batches become a tenth of it.
    """
    if spark.conf.get(BATCH_KEY) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); a temporary one only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="ligatura-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the shared folder; within ``scratch`` in its folder, unless the table is to be kept."""
    folder = None if keep else _SCRATCH.get()
    return f"{folder or shared_folder(spark) + '/ligatura'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written within go at the end, but for those written with ``keep``."""
    folder = shared_path(spark, "scratch", keep=True)
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int, read: int | None = None) -> Iterator[None]:
    """Jobs run within hand ``rows`` rows at a time to Python workers: few where rows are large, many where they are numbers.

    ``read``: rows that the Parquet reader decodes at a time, for tables whose rows are megabytes.
    """
    wanted = {BATCH_KEY: str(rows)} | ({READ_KEY: str(read)} if read else {})
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name, keep)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What tasks of this Python worker keep for the next ones, by name.
KEPT: dict[str, object] = {}


def give_back() -> None:
    """Drop what other operators' tasks keep in this Python worker, and return free memory to the system.

    Workers outlive their operator, and free memory stays with the allocator: an executor would hold it all beside the next
    operator's.
    """
    KEPT.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


Body = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def afresh(run: Body) -> Body:
    """``run`` in a worker that holds nothing of other operators' tasks."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        return run(batches)

    return start


def mapped_rows(docs: DataFrame, run: Body) -> DataFrame:
    """``docs`` through ``run``, which gets and gives batches of the columns of ``docs``, whatever their names."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))

    def named(batches: Iterator[pa.RecordBatch], to: list[str]) -> Iterator[pa.RecordBatch]:
        return (pa.RecordBatch.from_arrays(b.columns, to) for b in batches)

    own = plain.columns
    return plain.mapInArrow(afresh(lambda batches: named(run(named(batches, names)), own)), plain.schema).toDF(*names)


def joined_evenly(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` (a written table) with the columns of ``right``, an aggregate by ``key``.

    Dealt by a second column as well: both sides then come from shuffles of the join's own, whose hot partitions adaptive
    execution splits, whereas an aggregate that is already dealt by the key would keep a hot key in one task.
    """
    part = F.pmod(F.col(key), F.lit(7))
    return left.withColumn("_part", part).join(right.withColumn("_part", part), [key, "_part"]).drop("_part")


def remainder(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % mod


def is_remainder(doc_id: Column | str, mod: int, value: int) -> Column:
    """``remainder == value``; false for a null id."""
    return F.coalesce(remainder(doc_id, mod) == value, F.lit(False))
