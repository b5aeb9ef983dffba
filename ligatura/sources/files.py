"""Sources and sinks: tab-separated records, id-list files, Parquet tables, JSON documents and logs."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Columns of a source file and of the id-list files.
RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_COLUMNS = ("source1_entity_id", "candidate_entity_ids")
SOURCES = ("source1", "source2", "source3")


def text_schema(columns: tuple[str, ...]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...] = RECORD_COLUMNS) -> DataFrame:
    """A tab-separated file with a header, no quoting, all strings; empty fields are null."""
    return spark.read.schema(text_schema(columns)).options(sep="\t", header="true", quote="", escape="", enforceSchema="true").csv(path)


def source_path(data_dir: str, split: str, source: str) -> str:
    return f"{data_dir}/{split}/{split}_{source}.tsv"


def union_sources(*tables: DataFrame) -> DataFrame:
    """The tables under one another, with ``src`` 1, 2, 3 in their order."""
    return reduce(DataFrame.unionByName, [t.withColumn("src", F.lit(k + 1)) for k, t in enumerate(tables)])


def read_records(spark: SparkSession, data_dir: str, split: str) -> DataFrame:
    return union_sources(*(read_tsv(spark, source_path(data_dir, split, s)) for s in SOURCES))


def explode_ids(table: DataFrame, entity: str = "source1_entity_id", ids: str = "matched_entity_ids") -> DataFrame:
    """(s, t): one row for each id of a comma-separated list; null and empty lists give none."""
    return table.select(F.col(entity).alias("s"), F.explode(F.split(ids, ",")).alias("t")).where("t != ''")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return explode_ids(read_tsv(spark, path, TRUTH_COLUMNS))


def id_lists(entities: DataFrame, links: DataFrame, ids: str) -> DataFrame:
    """One row for each entity (column ``s``): its distinct linked ids (s, t), sorted and comma-joined, else an empty string."""
    lists = links.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("t")), ",").alias(ids))
    return entities.select("s").join(lists, "s", "left").select(F.col("s").alias("source1_entity_id"), F.coalesce(ids, F.lit("")).alias(ids))


def write_tsv(table: DataFrame, path: str, one_file: bool = False) -> None:
    """Tab-separated, with a header, never quoted, nulls empty. ``one_file`` is for results small enough for one task."""
    out = table.coalesce(1) if one_file else table
    out.write.mode("overwrite").options(sep="\t", header="true", quote="", emptyValue="", nullValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def write_table(table: DataFrame, path: str, *partition_by: str) -> None:
    writer = table.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def kept(table: DataFrame, name: str) -> DataFrame:
    """``table``, written once to a new path in the folder that driver and executors share (``spark.checkpoint.dir``; a temporary one
    only where it is unset) and read from there: what is made of it has a short plan. The files stay, as results read them.
    """
    spark = table.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="ligatura-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/ligatura/{name}-{uuid.uuid4().hex}"
    write_table(table, path)
    return spark.read.schema(table.schema).parquet(path)


def table_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the footers alone."""
    return spark.read.parquet(path).schema.names


def _place(path: str) -> tuple[Any, Any, Any]:
    """(JVM, file system, path) of any path that Spark reads: local, HDFS or an object store."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark._jvm, place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(path: str) -> bool:
    _, system, place = _place(path)
    return system.exists(place)


def folders(path: str) -> list[str]:
    """Names of the folders in a folder; none if it isn't there."""
    _, system, place = _place(path)
    return sorted(f.getPath().getName() for f in system.listStatus(place) if f.isDirectory()) if system.exists(place) else []


def cached_table(spark: SparkSession, path: str, build: Callable[[], DataFrame], made_of: Any = None) -> DataFrame:
    """The table at ``path``, built and written first if it isn't there, or was made of something else (ids, a model's name and time)."""
    note = f"{path}.made_of.json"
    if not exists(f"{path}/_SUCCESS") or (read_json(note) if exists(note) else None) != made_of:
        write_table(build(), path)
        write_json(made_of, note)
    return spark.read.parquet(path)


def write_json(document: Any, path: str) -> None:
    """A JSON document; a reader finds the old one or the new one, never a part."""
    jvm, system, place = _place(path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = system.create(part, True)
    out.write(json.dumps(document, indent=1).encode())
    out.close()
    system.delete(place, False)
    system.rename(part, place)


def read_json(path: str) -> Any:
    jvm, system, place = _place(path)
    stream = system.open(place)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def append_jsonl(record: dict[str, Any], path: str) -> None:
    """One more record: a file of its own in the folder ``path``, so that stores without appending will do."""
    jvm, system, place = _place(path)
    number = len(system.listStatus(place)) if system.exists(place) else 0
    out = system.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{number:08d}-{uuid.uuid4().hex}.jsonl"), True)
    out.write((json.dumps(record) + "\n").encode())
    out.close()


def read_jsonl(path: str) -> list[dict[str, Any]]:
    """The records of ``append_jsonl``, in order."""
    jvm, system, place = _place(path)
    out = []
    for name in sorted(f.getPath().getName() for f in system.listStatus(place)):
        stream = system.open(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
        out += [json.loads(line) for line in jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()]
        stream.close()
    return out


def fingerprint(folder: str, ending: str = ".tsv") -> dict[str, list[int]]:
    """Size and time of each file, to tell whether the inputs changed."""
    _, system, place = _place(folder)
    root, found, out = system.makeQualified(place).toString(), system.listFiles(place, True), {}
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString().removeprefix(root).lstrip("/")
        if name.endswith(ending):
            out[name] = [f.getLen(), f.getModificationTime()]
    return dict(sorted(out.items()))
