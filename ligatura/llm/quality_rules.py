"""Operator 5: quality rules from gradient-boosted trees.

A bounded sample of labelled documents (``sample_rows``, 20,000 by default, the first by hash of the id) trains boosted
histogram trees with a logistic loss on the driver. Chosen features are monotonic: a split that would let the score rise
with symbols, repeats, capitals and the like is refused, and bounds handed down to the children keep whole trees
monotonic. The trees are flattened into node arrays, and all documents are scored in one pass of array lookups.

Nulls and edge cases: a null text counts as an empty one; an empty text has no words and fails the base rules; a very long
text is read whole; a null label is no label; repeated labels of a document count once each, and of all rows of repeated
ids at most ``sample_rows`` train; a score at the threshold keeps; with no usable labels the verdict is "keep" and only
the base rules decide; repeated rows are judged one by one, alike; an empty table gives no rows; other columns of the input
pass ``filter_documents`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.llm.common import afresh, is_remainder, mapped_rows, table
from ligatura.llm.docstats import BASE, FEATURES, base_counts, statistics
from ligatura.llm.textkit import Words, blocks

#: Features whose rise may only lower the score (-1) or only raise it (+1).
MONOTONE = {
    "symbols_per_char": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "bang_per_word": -1,
    "pipe_per_word": -1, "same_next_share": -1, "distinct_share": 1,
}


@dataclass
class Forest:
    """Flattened trees: node i splits ``feature[i]`` at ``threshold[i]`` into ``left[i]`` and ``left[i] + 1``; leaves have feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root, np.int64)
            for _ in range(self.depth):
                f = self.feature[node]
                go = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(f >= 0, self.left[node] + go, node)
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


@dataclass
class _Tree:
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for column, empty in ((self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.value, 0.0)):
            column.append(empty)
        return len(self.feature) - 1


def fit_forest(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 40, depth: int = 4, bins: int = 64, rate: float = 0.2, l2: float = 1.0, least: float = 5.0) -> Forest:
    """Boost ``trees`` histogram trees under a logistic loss; ``monotone`` has -1, 0 or 1 for each feature."""
    prior = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.999
    base = float(np.log(prior / (1 - prior)))
    all_trees = _Tree()
    roots: list[int] = []
    n, n_features = x.shape
    if len(y) and y.min() != y.max():
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            root = all_trees.add()
            roots.append(root)
            todo = [(root, np.arange(n), 0, -np.inf, np.inf)]
            while todo:
                node, rows, level, low, high = todo.pop()
                gs, hs = g[rows].sum(), h[rows].sum()
                best = None
                if level < depth:
                    for f, e in enumerate(edges):
                        if not len(e):
                            continue
                        b = binned[rows, f]
                        gl = np.cumsum(np.bincount(b, g[rows], len(e) + 1))[:-1]
                        hl = np.cumsum(np.bincount(b, h[rows], len(e) + 1))[:-1]
                        gr, hr = gs - gl, hs - hl
                        vl = np.clip(-gl / (hl + l2), low, high)
                        vr = np.clip(-gr / (hr + l2), low, high)
                        gain = -(gl * vl + 0.5 * (hl + l2) * vl**2) - (gr * vr + 0.5 * (hr + l2) * vr**2)
                        bad = (hl < least / 20) | (hr < least / 20)
                        if monotone[f]:
                            bad |= (vr - vl) * monotone[f] < 0
                        gain[bad] = -np.inf
                        k = int(np.argmax(gain))
                        if np.isfinite(gain[k]) and (best is None or gain[k] > best[0]):
                            best = (gain[k], f, k, vl[k], vr[k])
                own = np.clip(-gs / (hs + l2), low, high)
                if best is None or best[0] <= -(gs * own + 0.5 * (hs + l2) * own**2) + 1e-9:
                    all_trees.value[node] = float(rate * own)
                    margin[rows] += rate * own
                    continue
                _, f, k, vl, vr = best
                left = all_trees.add()
                all_trees.add()
                all_trees.feature[node], all_trees.threshold[node], all_trees.left[node] = f, float(edges[f][k]), left
                mid = (vl + vr) / 2
                bound = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[int(monotone[f])]
                go = binned[rows, f] > k
                todo += [(left, rows[~go], level + 1, *bound[0]), (left + 1, rows[go], level + 1, *bound[1])]
    to = np.asarray
    return Forest(to(all_trees.feature, dtype=np.int64), to(all_trees.threshold), to(all_trees.left, dtype=np.int64), to(all_trees.value), to(roots, dtype=np.int64), base, depth)


def labelled_statistics(docs: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``sample_rows`` labelled documents, the first by hash of the id."""
    chosen = (
        labels.select("doc_id", F.col("quality").cast("double").alias("label"))
        .where("doc_id is not null and label is not null").where(~is_remainder("doc_id", 5, 0))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    )
    got = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most sample_rows rows
    schema = "label double, x array<double>"

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, buf, bounds in blocks(batch.column("text")):
                w = Words(buf, bounds)
                x = statistics(w, base_counts(w))
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(first, len(x)), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    # repeated ids in the documents don't add rows: the bound holds for what comes to the driver
    rows = got.select("text", "label").mapInArrow(afresh(stats), schema).orderBy(F.xxhash64("x"), "label").limit(sample_rows).toPandas()
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(FEATURES)))
    order = np.lexsort((*x.T, rows["label"].to_numpy()))
    return x[order], rows["label"].to_numpy()[order]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Forest:
    x, y = labelled_statistics(docs, labels, sample_rows)
    return fit_forest(x, y, np.array([MONOTONE.get(f, 0) for f in FEATURES]))


def judge(docs: DataFrame, forest: Forest, min_score: float = 0.3) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept for every row of ``docs``."""
    counts = ", ".join(f"{c} long" for c in BASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, buf, bounds in blocks(batch.column("text")):
                w = Words(buf, bounds)
                base = base_counts(w)
                failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
                score = forest.score(statistics(w, base))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(base)), *(pa.array(c) for c in base.T), pa.array(failed), pa.array(score), pa.array(~failed & (score >= min_score))],
                    ["doc_id", *BASE, "base_failed", "score", "kept"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {counts}, base_failed boolean, score double, kept boolean")


def filter_documents(docs: DataFrame, forest: Forest, min_score: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns: the verdict is made beside the row, without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for _, buf, bounds in blocks(batch.column("text")):
                w = Words(buf, bounds)
                base = base_counts(w)
                failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
                keep.append(~failed & (forest.score(statistics(w, base)) >= min_score))
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return mapped_rows(docs, run)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
