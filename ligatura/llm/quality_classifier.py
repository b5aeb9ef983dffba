"""Operator 1: quality classifier with random Fourier features, ridge regression and isotonic calibration.

Document statistics are computed once for whole texts and written to the shared folder (some 20 numbers a document).
Random Fourier features approximate a Gaussian kernel over the standardised statistics. Every partition of labelled rows
sums its own normal equations; the sums meet by cell, so the driver gets one (D+1) x (D+2) system whatever the input.
Ridge scores of labelled rows that the fit did not see are counted in 512 score bins by label; pool-adjacent-violators on
the bins gives the monotone calibration.

Labels come only from rows whose crc32 remainder modulo 5 is not 0; of these, remainder 1 calibrates and the rest fit.
Nulls and edge cases: null text is empty and is scored like any text, a very long one whole; null labels or ids train
nothing; a document labelled twice counts twice; equal statistics get equal scores, so ties and repeated rows agree; with
labels of one class, or none, the score is that class's share (1.0 with none); an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.llm.common import is_remainder, remainder, table, written
from ligatura.llm.docstats import FEATURES, base_counts, statistics
from ligatura.llm.textkit import Words, blocks

N_FOURIER = 192
GAMMA = 0.25
RIDGE = 1e-2
BINS = 512
THRESHOLD = 0.3


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics ``x`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, buf, bounds in blocks(batch.column("text")):
                w = Words(buf, bounds)
                x = statistics(w, base_counts(w))
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(x)), lists], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Fourier:
    """z(x) = sqrt(2/D) cos(W (x - mean) / scale + b), and a constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        u = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.cos(u @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(x), 1))])


def fourier(mean: np.ndarray, std: np.ndarray, n: int = N_FOURIER, gamma: float = GAMMA, seed: int = 7) -> Fourier:
    rng = np.random.default_rng(seed)
    scale = np.where(std > 1e-9, std, 1.0)
    weights = rng.normal(0, np.sqrt(2 * gamma / max(len(mean), 1)), (len(mean), n))
    return Fourier(mean, scale, weights, rng.uniform(0, 2 * np.pi, n))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, len(FEATURES))


def normal_equations(train: DataFrame, z: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Sum Z'Z and Z'y over all rows (x, label): by partition in numpy, then by cell in Spark."""
    d = len(z.phase) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        for batch in batches:
            if batch.num_rows:
                a = z(_matrix(batch.column("x")))
                total[:, :d] += a.T @ a
                total[:, d] += a.T @ batch.column("label").to_numpy(zero_copy_only=False)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "v"])

    cells = train.select("x", "label").mapInArrow(partial, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros(d * (d + 1))
    total[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    total = total.reshape(d, d + 1)
    return total[:, :d], total[:, d]


def pool(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the nearest non-decreasing sequence under these weights."""
    stack: list[list[float]] = []
    for w, m in zip(weight, mean, strict=True):
        stack.append([w, m, 1])
        while len(stack) > 1 and stack[-2][1] >= stack[-1][1]:
            w2, m2, k2 = stack.pop()
            w1, m1, k1 = stack.pop()
            stack.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), k1 + k2])
    return np.concatenate([np.full(int(k), m) for _, m, k in stack]) if stack else np.zeros(0)


@dataclass
class Model:
    z: Fourier
    beta: np.ndarray
    at: np.ndarray  # centres of score bins that had rows
    level: np.ndarray  # calibrated probabilities there, not decreasing

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.z(x) @ self.beta
        return np.interp(raw, self.at, self.level) if len(self.at) > 1 else np.full(len(x), self.level[0])


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("doc_id is not null and label is not null")
    rows = stats.join(known, "doc_id").where(~is_remainder("doc_id", 5, 0)).withColumn("part", remainder("doc_id", 5))
    k = len(FEATURES)
    summary = rows.agg(
        F.count("*").alias("n"), F.avg("label").alias("share"),
        *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)), *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k)),
    ).first()
    n, share = summary["n"], summary["share"]
    mean = np.array([summary[f"m{i}"] or 0.0 for i in range(k)])
    std = np.array([summary[f"s{i}"] or 0.0 for i in range(k)])
    z = fourier(mean, std)
    if not n or share in (0.0, 1.0):
        return Model(z, np.zeros(len(z.phase) + 1), np.zeros(1), np.array([1.0 if share is None else share]))
    gram, target = normal_equations(rows.where("part != 1"), z)
    beta = np.linalg.solve(gram + RIDGE * max(gram[-1, -1], 1.0) * 1e-3 * np.eye(len(gram)), target)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = z(_matrix(batch.column("x"))) @ beta
                b = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(b), batch.column("label")], ["bin", "label"])

    seen = rows.where("part = 1").select("x", "label").mapInArrow(binned, "bin int, label double")
    bins = seen.groupBy("bin").agg(F.count("*").alias("n"), F.avg("label").alias("y")).orderBy("bin").toPandas()
    if bins.empty:
        return Model(z, beta, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    level = np.clip(pool(bins["n"].to_numpy(float), bins["y"].to_numpy(float)), 0, 1)
    return Model(z, beta, (bins["bin"].to_numpy() + 0.5) * 2 / BINS - 0.5, level)


def score(stats: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.clip(model.score(_matrix(batch.column("x"))), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(with_statistics(table(spark, sf_dir, "documents")), "statistics")
    scored = score(stats, fit(stats, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_remainder("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
