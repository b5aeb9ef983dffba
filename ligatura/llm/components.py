"""Connected components of an edge list by alternating large-star and small-star steps; nothing comes to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ligatura.llm.common import joined_evenly, written


def unite(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``a[i]`` and ``b[i]`` in ``up``, where every place names the least of its tree."""
    while len(a):
        x, y = up[a], up[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while len(a):
            above = up[up]
            if np.array_equal(above, up):
                break
            up[:] = above


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's greater (large) or other lesser (small) neighbours on its least neighbour, itself included."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = joined_evenly(both, least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars: what a union-find over each batch leaves. A shorter list with the same components."""
    for batch in batches:
        names, ends = np.unique(np.concatenate([batch.column("a").to_numpy(), batch.column("b").to_numpy()]), return_inverse=True)
        up = np.arange(len(names))
        unite(up, *ends.reshape(2, -1))
        keep = up != np.arange(len(names))
        yield pa.RecordBatch.from_arrays([pa.array(names[keep]), pa.array(names[up[keep]])], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), where root is the least node of its component."""
    state = written(edges.where("a != b").select("a", "b").mapInArrow(_contract, "a long, b long").distinct(), "edges")
    mark = lambda df: df.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()
    before = mark(state)
    while True:
        state = written(_star(_star(state, True), False), "edges")
        now = mark(state)
        if now == before:
            break
        before = now
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
