"""Calibration of scores: Platt and isotonic fits on compressed counts, their application as columns, and metrics.

Fits need only (score, label, count) on a fine grid of scores, so the driver gets at most 10,001 rows whatever the data.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ligatura.functions.columns import Value, col
from ligatura.operators.relational import equal_frequency_bins, width_bin

EPS, CLIP = 1e-6, 12.0


def logit(p: Value) -> Column:
    q = F.least(F.greatest(col(p), F.lit(EPS)), F.lit(1 - EPS))
    return F.log(q / (1 - q))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def shift_prior(p: Value, odds: float | Column) -> Column:
    """``p`` with its odds multiplied."""
    return sigmoid(logit(p) + F.log(odds if isinstance(odds, Column) else F.lit(float(odds))))


def inverse_shift(threshold: float, odds: float) -> float:
    """The threshold on unshifted scores that equals ``threshold`` on scores shifted by ``odds``."""
    t = min(max(threshold, EPS), 1 - EPS)
    return 1 / (1 + math.exp(-(math.log(t / (1 - t)) - math.log(odds))))


def compressed(df: DataFrame, score: str, label: str, digits: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, positives, rows) by rounded score."""
    rows = df.groupBy(F.round(score, digits).alias("p")).agg(F.sum(F.col(label).cast("double")).alias("y"), F.count("*").alias("n")).orderBy("p").toPandas()
    return rows["p"].to_numpy(float), rows["y"].to_numpy(float), rows["n"].to_numpy(float)


def fit_platt_counts(p: np.ndarray, y: np.ndarray, n: np.ndarray, l2: float = 1e-3, steps: int = 100) -> dict[str, Any]:
    """Damped Newton for sigmoid(a * logit + b), drawn towards the identity; the identity if the fit isn't better."""
    q = np.clip(p, EPS, 1 - EPS)
    x = np.clip(np.log(q / (1 - q)), -CLIP, CLIP)
    total = max(n.sum(), 1)

    def loss(v: np.ndarray) -> float:
        z = v[0] * x + v[1]
        return float((np.logaddexp(0, -z) * y + np.logaddexp(0, z) * (n - y)).sum() + 0.5 * l2 * ((v[0] - 1) ** 2 + v[1] ** 2)) / total

    v = np.array([1.0, 0.0])
    identity = now = loss(v)
    for _ in range(steps):
        s = 1 / (1 + np.exp(-(v[0] * x + v[1])))
        r, w = s * n - y, s * (1 - s) * n + 1e-12
        g = np.array([(r * x).sum() + l2 * (v[0] - 1), r.sum() + l2 * v[1]])
        h = np.array([[(w * x * x).sum() + l2, (w * x).sum()], [(w * x).sum(), w.sum() + l2]])
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and not loss(v - size * step) < now:
            size /= 2
        if size <= 1e-6:
            break
        v = v - size * step
        now = loss(v)
        if np.abs(size * step).max() < 1e-9:
            break
    out = {"method": "platt", "a": float(v[0]), "b": float(v[1]), "log_loss": now, "identity_log_loss": identity}
    if not np.isfinite(now) or now > identity or not 1e-3 < abs(v[0]) < 1e3:
        out.update(a=1.0, b=0.0, fallback="identity")
    return out


def fit_platt(df: DataFrame, score: str, label: str) -> dict[str, Any]:
    return fit_platt_counts(*compressed(df, score, label))


def pool_violators(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[list[float], list[float]]:
    """(left-most x, level) of each pool of the non-decreasing fit."""
    blocks: list[tuple[float, float, float]] = []
    for xi, yi, wi in zip(x, y, w, strict=True):
        blocks.append((float(xi), float(yi), float(wi)))
        while len(blocks) > 1 and blocks[-2][1] > blocks[-1][1]:
            (x0, y0, w0), (_, y1, w1) = blocks[-2:]
            blocks[-2:] = [(x0, (y0 * w0 + y1 * w1) / (w0 + w1), w0 + w1)]
    return [b[0] for b in blocks], [b[1] for b in blocks]


def fit_isotonic(df: DataFrame, score: str, label: str, ties: list[str], bins: int = 2000) -> dict[str, Any]:
    rows = equal_frequency_bins(df, score, label, ties, bins).orderBy("bin").toPandas()  # at most ``bins`` rows
    x, y = pool_violators(rows["x"].to_numpy(float), rows["y"].to_numpy(float), rows["w"].to_numpy(float))
    return {"method": "isotonic", "x": x, "y": y}


def apply(calibrator: dict[str, Any] | None, p: Value) -> Column:
    """Calibrated scores; isotonic levels hold from their x up to the next."""
    method = (calibrator or {}).get("method", "identity")
    if method == "identity":
        return col(p)
    if method == "platt":
        z = F.least(F.greatest(logit(p), F.lit(-CLIP)), F.lit(CLIP))
        return sigmoid(calibrator["a"] * z + calibrator["b"])
    if method == "isotonic":
        xs, ys = F.array(*map(F.lit, calibrator["x"])), F.array(*map(F.lit, calibrator["y"]))
        at = F.size(F.filter(xs, lambda x: x <= col(p)))
        return F.element_at(ys, F.greatest(at, F.lit(1)))
    raise ValueError(f"unknown calibrator {method!r}")


def metrics(df: DataFrame, score: str, label: str, bins: int = 15, by: tuple[str, ...] = ()) -> DataFrame:
    """([by,] log_loss, brier, ece) of scores against labels, from sums over bins of equal width: the rows are read once."""
    y, p = F.col(label).cast("double"), F.least(F.greatest(F.col(score), F.lit(EPS)), F.lit(1 - EPS))
    parts = {"loss": -(y * F.log(p) + (1 - y) * F.log(1 - p)), "sq": (F.col(score) - y) * (F.col(score) - y)}
    cells = df.groupBy(*by, width_bin(score, bins).alias("_bin")).agg(
        F.count("*").alias("_n"), F.abs(F.avg(score) - F.avg(y)).alias("_gap"), *(f(c).alias(f"_{f.__name__}_{name}") for name, c in parts.items() for f in (F.sum, F.count))
    )
    mean = lambda name: F.sum(f"_sum_{name}") / F.nullif(F.sum(f"_count_{name}"), F.lit(0))
    ece = F.sum(F.col("_n") * F.col("_gap")) / F.nullif(F.sum("_n"), F.lit(0))
    return cells.groupBy(*by).agg(mean("loss").alias("log_loss"), mean("sq").alias("brier"), ece.alias("ece"))


def nested_report(df: DataFrame, score: str, label: str, fold: str, folds: list[int], ties: list[str]) -> dict[str, dict[str, float]]:
    """Metrics of each method, fitted on the other folds and applied to each."""
    out = {}
    for method in ("identity", "platt", "isotonic"):
        scored = None
        for k in folds:
            rest, held = df.where(F.col(fold) != k), df.where(F.col(fold) == k)
            cal = {"method": "identity"} if method == "identity" else fit_platt(rest, score, label) if method == "platt" else fit_isotonic(rest, score, label, ties)
            part = held.select(apply(cal, score).alias("_p"), F.col(label).alias("_y"))
            scored = part if scored is None else scored.unionByName(part)
        out[method] = metrics(scored, "_p", "_y").first().asDict()
    return out
