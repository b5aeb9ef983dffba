"""Operator 7: token ids as Parquet list columns that can be read selectively.

Documents are dealt by ranges of doc_id, so that shard k holds smaller ids than shard k+1, and written in ascending order
as (doc_id, shard, start_in_shard, n_tokens, ids). The writer is Parquet's version 2: ids are dictionary-encoded (their
vocabulary fits one dictionary page), doc_id and the offsets delta-encoded; row groups and pages have fixed sizes and the
files carry page indexes, so ``read_tokens`` of an id range or of metadata alone touches only the pages it needs.
Global offsets aren't stored: they are the shard's place plus ``start_in_shard``, from one sum a shard.

Nulls and edge cases: a null text is an empty document (the end id alone); a very long one is one list; equal doc_ids stand
side by side, ordered by text, repeated rows one by one; a null doc_id comes first; an empty table gives files without
rows; other columns aren't written, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ligatura.llm.common import shared_path, table
from ligatura.llm.tokens import END_ID, crc32, text_slices, worker_cache

TOKENIZER = "byte_bpe_50k.json"
SCHEMA = "doc_id long, shard int, start_in_shard long, n_tokens long, ids array<int>"
#: Parquet's writer: delta encodings (version 2), dictionaries, 16 MB row groups, 256 kB pages of at most 20,000 rows.
WRITER = {
    "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true", "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10), "parquet.dictionary.page.size": str(1 << 20), "parquet.page.row.count.limit": "20000",
    "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#start_in_shard": "false",
}


def encode_shards(docs: DataFrame, tokenizer: str = TOKENIZER, path: str | None = None) -> DataFrame:
    """Documents in ascending doc_id order over shards, as rows of ``SCHEMA``."""
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard, at = worker_cache(tokenizer, path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in text_slices(batch.column("text")):
                ids, bounds = cache.encode(texts, END_ID)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(np.full(n, shard, np.int32)), pa.array(at + bounds[:-1]), pa.array(np.diff(bounds)), lists],
                    ["doc_id", "shard", "start_in_shard", "n_tokens", "ids"],
                )
                at += int(bounds[-1])

    return ordered.mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, tokenizer_file: str | None = None) -> None:
    encode_shards(docs, tokenizer, tokenizer_file).write.options(**WRITER).mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def shard_places(files: DataFrame) -> DataFrame:
    """(shard, place): ids in all shards before. One row a shard; only the two metadata columns are read."""
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("place"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    files = read_tokens(spark, path)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ids, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
            sums = [crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), batch.column("start_in_shard"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "shard", "start_in_shard", "n_tokens", "ids_crc32"],
            )

    read = files.select("doc_id", "shard", "start_in_shard", "ids").mapInArrow(check, "doc_id long, shard int, start_in_shard long, n_tokens long, ids_crc32 long")
    placed = read.join(F.broadcast(shard_places(files)), "shard")  # one row a shard: no more than the writer had partitions
    return placed.select("doc_id", (F.col("place") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")
