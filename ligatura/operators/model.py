"""Cross-fitted two-stage boosted trees over pair features.

Model k never sees a pair whose entity's or query's fold is k, and scores exactly the pairs of entity fold k. The second
stage adds context features made of the first stage's out-of-fold scores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ligatura.operators import decide
from ligatura.operators.pairs import STAGE_1, STAGE_2, stage2_context

DEPTH, RATE, SUBSAMPLE, LEAST_ROWS, BINS = 5, 0.1, 0.8, 5, 255


def vectors(pairs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error").transform(pairs)


def classifier(rounds: int, depth: int = DEPTH, seed: int = 7) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=RATE, subsamplingRate=SUBSAMPLE, minInstancesPerNode=LEAST_ROWS, maxBins=BINS, featureSubsetStrategy="0.8", seed=seed)


def probability(model: GBTClassificationModel, pairs: DataFrame, name: str) -> DataFrame:
    return model.transform(pairs).withColumn(name, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def cross_fit(pairs: DataFrame, names: tuple[str, ...], folds: list[int], rounds: int, score: str, depth: int = DEPTH) -> tuple[DataFrame, list[GBTClassificationModel]]:
    """``pairs`` with out-of-fold scores, and the models by fold. ``pairs`` should be written or cached."""
    ready = vectors(pairs, names)
    parts, models = [], []
    for k in folds:
        model = classifier(rounds, depth).fit(ready.where((F.col("s_fold") != k) & (F.col("t_fold") != k)))
        models.append(model)
        parts.append(probability(model, ready.where(F.col("s_fold") == k), score))
    return reduce(DataFrame.unionByName, parts).drop("features"), models


def two_stages(pairs: DataFrame, house_numbers: DataFrame, folds: list[int], rounds: tuple[int, int] = (20, 15), stage2: bool = True) -> tuple[DataFrame, list, list]:
    """Out-of-fold p1 and p2 of pairs with the first-stage features, label and folds; without a second stage p2 is p1."""
    first, models1 = cross_fit(pairs, STAGE_1, folds, rounds[0], "p1")
    if not stage2:
        return first.withColumn("p2", F.col("p1")), models1, []
    hn = house_numbers.select("id", F.coalesce("a_hn", F.lit("")).alias("hn"))
    both = first.join(hn.toDF("t", "t_hn"), "t").join(hn.toDF("s", "s_hn"), "s")
    second, models2 = cross_fit(stage2_context(both).drop("t_hn", "s_hn"), STAGE_2, folds, rounds[1], "p2")
    return second, models1, models2


def importance(model: GBTClassificationModel, names: tuple[str, ...]) -> list[tuple[str, float]]:
    return sorted(zip(names, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def ablation(pairs: DataFrame, house_numbers: DataFrame, folds: list[int], truth: DataFrame, entities: DataFrame, groups: dict[str, tuple[str, ...]], rounds: tuple[int, int] = (20, 15), stage2: bool = True) -> list[dict]:
    """Best macro F of the whole model and of the model without each group of features, which become constants, and without the second stage.

    ``pairs`` should be written: every run reads it.
    """
    out: list[dict] = []
    for name, dropped in {"baseline": (), **groups, **({"stage2": ()} if stage2 else {})}.items():
        less = pairs.withColumns({c: F.lit(0.0) for c in dropped}) if dropped else pairs
        scored, _, _ = two_stages(less, house_numbers, folds, rounds, stage2 and name != "stage2")
        links = decide.link_table(scored.select("t", "s", F.col("p2").alias("p")), truth)
        best = decide.best_threshold(decide.sweep(links, decide.entity_table(entities, truth))).first()
        base = out[0]["macro_f05"] if out else best["macro_f05"]
        out.append({"removed": name, "features": len(dropped), "threshold": best["threshold"], "macro_f05": best["macro_f05"], "gain": best["macro_f05"] - base})
    return out
