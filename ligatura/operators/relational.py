"""Relational operators that the engine is built of, as DataFrame functions.

Ties are always broken by explicit keys, so results don't depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ligatura.functions.columns import Value, col


def left_default(left: DataFrame, right: DataFrame, on: list[str], defaults: dict[str, object]) -> DataFrame:
    """Left join with literals in place of missing values."""
    out = left.join(right, on, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def membership(left: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """Whether each row's key is among ``keys``, as a column."""
    return left.join(keys.select(on).distinct().withColumn(name, F.lit(True)), on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def gather_sides(pairs: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """``pairs`` (t, s) with both records' columns, prefixed t_ and s_."""
    t, s = prefixed(records, "t_"), prefixed(records, "s_")
    both = pairs.join(s, pairs["s"] == s[f"s_{key}"]).join(t, pairs["t"] == t[f"t_{key}"])  # left as dealt by t, for windows by t
    return both.select(*pairs.columns, *t.columns, *s.columns)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rn") -> DataFrame:
    """The first ``k`` rows of each key; the limit reaches below the window's shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def argmax_per_key(df: DataFrame, keys: list[str], score: str, ties: list[str]) -> DataFrame:
    """The row of highest score of each key; ties go to the least of ``ties``. Aggregated, so hot keys combine early."""
    value = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(-F.col(score), *[F.col(c) for c in ties])
    return df.groupBy(*keys).agg(F.min_by(value, order).alias("_v")).select("_v.*")


def leave_one_out_sum(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    window = Window.partitionBy(*keys)
    return df.withColumn(name, F.sum(value).over(window) - value)


def second_best(score: Value, keys: list[str]) -> Column:
    """The second highest score of the key; null if there is none."""
    frame = Window.partitionBy(*keys).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.nth_value(score, 2).over(frame)


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def most_common(counts: DataFrame, keys: list[str], value: str, least: int, share: float, total: str | None = None) -> DataFrame:
    """Each key's most frequent value with at least ``least`` and ``share`` of the key's total; ties to the least value."""
    own = Window.partitionBy(*keys)
    sums = counts.withColumn("_total", F.max(total).over(own) if total else F.sum("n").over(own))
    best = top_per_key(sums, keys, [F.desc("n"), F.asc(value)], 1)
    return best.where((F.col("n") >= least) & (F.col("n") >= share * F.col("_total"))).select(*keys, value, "n", F.col("_total").alias("total"))


def leave_one_fold_out(counts: DataFrame, folds: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of all folds but k, for each k of ``folds`` (column ``fold``; a few rows); k null takes all in.

    Everything is summed once by fold; a key's total less its own fold's count is the rest.
    """
    total = counts.groupBy(*keys).agg(F.sum("n").alias("all_n"))
    own = counts.select(*keys, "fold", "n").groupBy(*keys, "fold").agg(F.sum("n").alias("own_n"))
    grid = total.join(F.broadcast(folds.select("fold").distinct()))  # folds: a handful of rows by definition
    rest = grid.join(own, [*keys, "fold"], "left").select(*keys, "fold", (F.col("all_n") - F.coalesce("own_n", F.lit(0))).alias("n"))
    every = total.select(*keys, F.lit(None).cast("int").alias("fold"), F.col("all_n").alias("n"))
    return rest.unionByName(every.select(*rest.columns)).where("n > 0")


def bucket(value: Value, n: int, seed: str = "") -> Column:
    """A bucket of 0..n-1 from the md5 of the value, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat(col(value).cast("string"), F.lit(seed))), 1, 8), 16, 10).cast("long") % n


def in_hash_range(value: Value, low: float, high: float, seed: str = "") -> Column:
    """Whether the value's hash lies in [low, high) of the unit interval."""
    n = 1_000_000
    b = bucket(value, n, seed)
    return (b >= int(low * n)) & (b < int(high * n))


def hash_range(df: DataFrame, value: Value, low: float, high: float, seed: str = "") -> DataFrame:
    return df.where(in_hash_range(value, low, high, seed))


def sample_exact(df: DataFrame, n: int, key: str, seed: str = "") -> DataFrame:
    """``n`` rows, the first by hash of the key: the sampling operator's own limit."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def width_bin(score: str, bins: int) -> Column:
    return F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("long")


def equal_width_bins(df: DataFrame, score: str, label: str, bins: int = 15) -> DataFrame:
    """(bin, n, mean_pred, frac_pos) over equal widths of [0, 1]."""
    return df.groupBy(width_bin(score, bins).alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_pred"), F.avg(F.col(label).cast("double")).alias("frac_pos"))


def _offsets(dealt: DataFrame, size: Column) -> DataFrame:
    """``dealt``, a kept table with its partitions as ``_p``, with ``_before``: what all partitions before a row's own hold."""
    sizes = dealt.groupBy("_p").agg(size.alias("_s"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return dealt.join(F.broadcast(before.select("_p", "_before")), "_p")  # a row a partition


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """A global 1-based rank without one task sorting all rows: rows are range-partitioned, sorted, and offset by partition.

    The sorted rows are kept, as the bounds of a second range partitioning come from another sample: sizes counted
    over other partitions than the rows' own give ranks that repeat and skip. ``df`` should have few columns.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    local = spread.withColumn("_k", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33) + 1).persist()
    return _offsets(local, F.count("*")).withColumn(name, F.col("_before") + F.col("_k")).drop("_p", "_k", "_before")


def equal_frequency_bins(df: DataFrame, score: str, label: str, ties: list[str], bins: int) -> DataFrame:
    """(bin, x, y, w): mean score, mean label and rows of bins of equal counts by score."""
    n = df.count()
    r = ranked(df.select(score, label, *ties), [F.asc(score), *map(F.asc, ties)], "_r")
    # bin j holds positions int(j*n/bins) .. int((j+1)*n/bins) - 1
    pos = F.col("_r") - 1
    j = F.floor((pos * bins + bins - 1) / F.lit(max(n, 1)))
    b = F.when(F.floor(j * n / bins) > pos, j - 1).otherwise(j).cast("long")
    return r.groupBy(b.alias("bin")).agg(F.avg(score).alias("x"), F.avg(F.col(label).cast("double")).alias("y"), F.count("*").alias("w"))


def rank_sum_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """(auc, n_pos, n_neg) with mid-ranks for ties, from counts per distinct score."""
    per = df.groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))
    below = ranked_cumulative(per, score, "n")
    u = F.sum(F.col("pos") * (F.col("cum") - F.col("n") + (F.col("n") + 1) / 2.0))
    tot = below.agg(u.alias("u"), F.sum("pos").alias("n_pos"), F.sum("n").alias("n"))
    n_neg = F.col("n") - F.col("n_pos")
    auc = (F.col("u") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0) / (F.col("n_pos") * n_neg)
    return tot.select(auc.alias("auc"), "n_pos", n_neg.alias("n_neg"))


def ranked_cumulative(df: DataFrame, order: str | list[str], value: str) -> DataFrame:
    """``cum``: the running sum of whole numbers ``value`` by ``order``, which names each row, by range partitions and their offsets; the partitions are kept as in ``ranked``."""
    order = [order] if isinstance(order, str) else order
    spread = df.withColumn(value, F.col(value).cast("long")).repartitionByRange(*map(F.asc, order)).sortWithinPartitions(*map(F.asc, order)).withColumn("_p", F.spark_partition_id())

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            cum = before + np.cumsum(batch[value].fill_null(0).to_numpy(zero_copy_only=False))
            before = int(cum[-1]) if len(cum) else before
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cum, pa.int64())], names=[*batch.schema.names, "_cum"])

    local = spread.mapInArrow(running, StructType([*spread.schema, StructField("_cum", LongType())])).persist()
    return _offsets(local, F.sum(value)).withColumn("cum", F.col("_cum") + F.col("_before")).drop("_p", "_cum", "_before")


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def union_distinct(*tables: DataFrame) -> DataFrame:
    return union_all(*tables).distinct()


def overlap(a: Value, b: Value) -> Column:
    """How many distinct elements two arrays share."""
    return F.size(F.array_intersect(col(a), col(b)))


def overlapping(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Every row of ``left`` with every row of ``right`` whose arrays ``a`` and ``b`` share elements; ``common`` says how many.

    Joined over shared elements by partial sums, so that pairs that share none are never made.
    """
    left, right = (df.withColumn(k, F.xxhash64(*df.columns)) for df, k in ((left, "_l"), (right, "_r")))
    # rows that are equal share a key
    index = [df.select(k, F.explode(F.array_distinct(c)).alias("_e")).distinct() for df, k, c in ((left, "_l", a), (right, "_r", b))]
    shared = index[0].join(index[1], "_e").groupBy("_l", "_r").agg(F.count("*").cast("int").alias("common"))
    return left.join(shared, "_l").join(right, "_r").drop("_l", "_r")


def difference(a: Value, b: Value) -> Column:
    return F.array_except(col(a), col(b))
