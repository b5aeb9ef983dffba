"""Isolation of training folds: lexicons that learned from their own fold, and a model that learns from shuffled labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ligatura.operators.model import cross_fit
from ligatura.operators.relational import rank_sum_auc, ranked

#: An out-of-fold AUC on shuffled labels from which rows must be shared between folds.
CANARY_LIMIT = 0.55


def lexicon_leaks(counts: DataFrame, lexicons: DataFrame) -> DataFrame:
    """(fold, key) of words that were seen in one fold only (counts: fold, key) and yet stand in that fold's own lexicon."""
    once = counts.groupBy("key").agg(F.min("fold").alias("fold"), F.countDistinct("fold").alias("n")).where("n = 1")
    return once.select("fold", "key").join(lexicons.where("fold is not null").select("fold", "key").distinct(), ["fold", "key"], "left_semi")


def shuffled(pairs: DataFrame, label: str = "label", fold: str = "s_fold", seed: str = "canary") -> DataFrame:
    """``pairs`` (t, s, ...) with their labels dealt anew within each fold, so that every fold keeps its share."""
    mixed = lambda salt: F.md5(F.concat_ws("|", "t", "s", F.lit(seed + salt)))
    # only keys are ranked: the features join again by the pair, which is unique
    places = ranked(pairs.select(fold, "t", "s"), [F.asc(fold), mixed("a").asc(), F.asc("t"), F.asc("s")], "_rank").select("_rank", "t", "s")
    labels = ranked(pairs.select(fold, "t", "s", label), [F.asc(fold), mixed("b").asc(), F.asc("t"), F.asc("s")], "_rank").select("_rank", label)
    return pairs.drop(label).join(places.join(labels, "_rank").drop("_rank"), ["t", "s"])


def canary_auc(pairs: DataFrame, names: tuple[str, ...], folds: list[int], rounds: int = 10) -> float:
    """Out-of-fold AUC of a model trained on shuffled labels; near 0.5 unless rows are shared between folds.

    ``pairs`` should be written: it is read several times.
    """
    scored, _ = cross_fit(shuffled(pairs).withColumn("label", F.col("label").cast("double")), names, folds, rounds, "p_shuffled")
    return rank_sum_auc(scored, "p_shuffled", "label").first()["auc"]
