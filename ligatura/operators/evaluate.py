"""Evaluation against the truth: entity-level and pair-level metrics, error classes, shift scenarios, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ligatura.operators import calibrate, decide
from ligatura.operators.relational import argmax_per_key, hash_range, in_hash_range, ranked_cumulative


def per_entity(pred: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    """(s, nt, np, tp, p, r, f) from lists of ids (s, m); rows of truth are the evaluation set."""
    both = truth.select("s", F.col("m").alias("true")).join(pred.select("s", F.col("m").alias("pred")), "s", "left")
    none = F.array().cast("array<string>")
    both = both.select("s", F.coalesce("true", none).alias("true"), F.coalesce("pred", none).alias("pred"))
    n = both.select("s", F.size("true").alias("nt"), F.size("pred").alias("np"), F.size(F.array_intersect("true", "pred")).alias("tp"))
    p = F.when(F.col("np") > 0, F.col("tp") / F.col("np")).otherwise(0.0)
    r = F.when(F.col("nt") > 0, F.col("tp") / F.col("nt")).otherwise(0.0)
    return n.select("*", p.alias("p"), r.alias("r"), decide.f_score(F.col("tp"), F.col("np"), F.col("nt"), beta * beta).alias("f"))


def summary(entities: DataFrame, *by: str) -> DataFrame:
    """Eleven numbers over per-entity rows, overall or by group."""
    single = F.col("nt") == 0
    share = lambda c: F.avg(c.cast("double"))
    at_least = lambda c: F.greatest(c, F.lit(1))
    return entities.groupBy(*by).agg(
        F.count("*").alias("n_entities"), F.avg("f").alias("macro_f05"), F.avg(F.when(~single, F.col("f"))).alias("macro_f05_non_singletons"), share(single).alias("singleton_share"),
        (F.sum((single & (F.col("np") == 0)).cast("long")) / at_least(F.sum(single.cast("long")))).alias("singleton_acc"),
        (F.sum("tp") / at_least(F.sum("np"))).alias("micro_precision"), (F.sum("tp") / at_least(F.sum("nt"))).alias("micro_recall"),
        F.avg(F.when(~single, F.col("p"))).alias("mean_entity_precision"), F.avg(F.when(~single, F.col("r"))).alias("mean_entity_recall"),
        share(F.col("f") == 1).alias("entities_perfect"), share(F.col("f") == 0).alias("entities_zero"),
    )


def macro_f(pred: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    """(n, macro_f05, micro_precision, micro_recall, singleton_acc)."""
    return summary(per_entity(pred, truth, beta)).select(F.col("n_entities").alias("n"), "macro_f05", "micro_precision", "micro_recall", "singleton_acc")


def pair_level(pairs: DataFrame, threshold: float) -> DataFrame:
    """(accuracy, positive_rate, precision, recall) of all candidate pairs (p, label) at a threshold."""
    hit, y = F.col("p") >= threshold, F.col("label") == 1
    n = lambda c: F.sum(c.cast("long"))
    at_least = lambda c: F.greatest(c, F.lit(1))
    return pairs.agg(F.avg((hit == y).cast("double")).alias("accuracy"), F.avg(y.cast("double")).alias("positive_rate"), (n(hit & y) / at_least(n(hit))).alias("precision"), (n(hit & y) / at_least(n(y))).alias("recall"))


def per_fold(links: DataFrame, entities: DataFrame, threshold: float) -> DataFrame:
    """(fold, macro_f05, n_entities) at one threshold; entities carry their fold."""
    scored = decide.entity_scores(links, entities, F.col("p") >= threshold)
    return scored.groupBy("fold").agg(F.avg("f").alias("macro_f05"), F.count("*").alias("n_entities"))


def fold_spread(rows: DataFrame) -> DataFrame:
    return rows.agg(F.avg("macro_f05").alias("mean"), F.stddev_pop("macro_f05").alias("std"), F.min("macro_f05").alias("least"), F.max("macro_f05").alias("most"))


def true_pair_outcomes(pairs: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """Each true pair as retrieval_miss, outranked, below_threshold or found."""
    best = argmax_per_key(pairs.select("t", "s", "p"), ["t"], "p", ["s"]).select("t", F.col("s").alias("best_s"), F.col("p").alias("p_best"))
    met = truth.join(pairs.select("t", "s", F.col("p").alias("p_true")), ["t", "s"], "left").join(best, "t", "left")
    kind = F.when(F.col("p_true").isNull(), "retrieval_miss").when(F.col("best_s") != F.col("s"), "outranked").when(F.col("p_best") < threshold, "below_threshold").otherwise("found")
    return met.withColumn("outcome", kind)


def false_links(pairs: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """Accepted links that aren't true: decoy_linked or wrong_entity."""
    true_s = truth.groupBy("t").agg(F.min("s").alias("true_s"))
    links = decide.assign(pairs, threshold).join(true_s, "t", "left").where(F.col("true_s").isNull() | (F.col("true_s") != F.col("s")))
    return links.withColumn("kind", F.when(F.col("true_s").isNull(), "decoy_linked").otherwise("wrong_entity"))


def shares(rows: DataFrame, kind: str, *flags: str) -> DataFrame:
    """By kind: rows and the share of each boolean attribute."""
    return rows.groupBy(kind).agg(F.count("*").alias("n"), *(F.avg(F.col(f).cast("double")).alias(f"{f}_share") for f in flags))


def scenario(name: str, pairs: DataFrame, truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, truth) of a shifted population, all chosen by hash: matched_x0.7, matched_x0.5, singletons_x2, source_2_only, source_3_only, indic_only.

    Sources need ``t_src`` among the pairs' columns, the last ``t_indic``. Denser decoys are a weight, not a population: see ``decide.sweep``.
    """
    if name.startswith("matched_x"):
        gone = hash_range(truth.select("t").distinct(), "t", float(name[9:]), 1.0, "matched")
        return pairs.join(gone, "t", "left_anti"), truth.join(gone, "t", "left_anti")
    if name == "singletons_x2":
        emptied = hash_range(truth.select("s").distinct(), "s", 0.0, 0.06, "single")
        return pairs, truth.join(emptied, "s", "left_anti")
    if name == "indic_only":
        kept = pairs.where("t_indic")
        return kept, truth.join(kept.select("t").distinct(), "t", "left_semi")
    if name.startswith("source_"):
        kept = pairs.where(F.col("t_src") == int(name.split("_")[1]))
        return kept, truth.join(kept.select("t").distinct(), "t", "left_semi")
    raise ValueError(f"unknown scenario {name!r}")


def robustness(pairs: DataFrame, truth: DataFrame, entities: DataFrame, threshold: float, names: list[str], decoys: tuple[float, ...] = (2.0, 3.0)) -> list[dict]:
    """Macro F at the trained threshold, the best one and the regret, for each scenario (a few jobs each)."""
    out = []
    for name in ["train_distribution", *names, *(f"decoys_x{d:g}" for d in decoys)]:
        weight = float(name[8:]) if name.startswith("decoys_x") else 1.0
        p, t = (pairs, truth) if name == "train_distribution" or weight != 1.0 else scenario(name, pairs, truth)
        links, ents = decide.link_table(p, t), decide.entity_table(entities, t)
        own = decide.best_threshold(decide.sweep(links, ents, decoy_weight=weight)).first()
        at = decide.metrics_at(links, ents, threshold, weight).first()
        out.append({"scenario": name, "at_threshold": at["macro_f05"], "own_threshold": own["threshold"], "own_best": own["macro_f05"], "regret": own["macro_f05"] - at["macro_f05"]})
    return out


def leakage_audit(features: DataFrame, names: list[str], label: str = "label") -> DataFrame:
    """(feature, auc, suspicious) of each feature alone; one that separates the labels all but perfectly leaks.

    One job for all: counts per feature and value, running sums over range partitions of (feature, value), mid-ranks.
    Values tie at nine digits, so that the order of a sum's terms can't turn ranks. Features are numbers until the end; totals come from the running sums' own rows, so that ``features`` is read once.
    """
    cells = F.posexplode(F.array(*(F.round(F.col(f).cast("double"), 9) for f in names))).alias("f", "x")
    per = features.select(F.col(label).cast("long").alias("y"), cells).groupBy("f", "x").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    run = ranked_cumulative(per, ["f", "x"], "n")
    # ranks count from the first row of all features: a feature's own begin after its least running sum
    below = F.col("cum") - F.col("n")
    sums = run.groupBy("f").agg(F.min(below).alias("before"), F.sum(F.col("pos").cast("decimal(38,1)") * (2 * below + F.col("n") + 1)).alias("u2"), F.sum("n").alias("n_all"), F.sum("pos").alias("n_pos"))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("f") + 1)
    one = sums.select(name.alias("feature"), "n_all", "n_pos", ((F.col("u2") - 2 * F.col("before") * F.col("n_pos")) / 2).cast("double").alias("u"))
    auc = (F.col("u") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0) / F.nullif(F.col("n_pos") * (F.col("n_all") - F.col("n_pos")), F.lit(0))
    rows = one.select("feature", auc.alias("auc"))
    return rows.withColumn("suspicious", F.coalesce((F.col("auc") < 0.001) | (F.col("auc") > 0.999), F.lit(False)))


def _in_scenario(name: str) -> tuple[Column, Column]:
    """(whether a pair is in the population of ``scenario``, whether it is true there), for pairs with ``_s``, the true ids of their query, null if it has none."""
    true = F.coalesce(F.array_contains("_s", F.col("s")), F.lit(False))
    if name == "train_distribution":
        return F.lit(True), true
    if name.startswith("matched_x"):
        return F.col("_s").isNull() | ~in_hash_range("t", float(name[9:]), 1.0, "matched"), true
    if name == "singletons_x2":
        return F.lit(True), true & ~in_hash_range("s", 0.0, 0.06, "single")
    if name == "indic_only":
        return F.col("t_indic"), true
    if name.startswith("source_"):
        return F.col("t_src") == int(name.split("_")[1]), true
    raise ValueError(f"unknown scenario {name!r}")


def calibration_under_shift(pairs: DataFrame, truth: DataFrame, names: list[str], score: str = "p") -> DataFrame:
    """(scenario, log_loss, brier, ece) of the scores against the labels of each shifted population; nulls for one without pairs.

    One join and one grouped job for all: a pair gives a row to every population that it is in.
    """
    names = ["train_distribution", *names]
    labelled = pairs.join(truth.groupBy("t").agg(F.collect_set("s").alias("_s")), "t", "left")
    cells = [F.when(kept, F.struct(F.lit(name).alias("scenario"), true.cast("int").alias("_y"))) for name, (kept, true) in ((n, _in_scenario(n)) for n in names)]
    rows = labelled.select(score, F.explode(F.array_compact(F.array(*cells))).alias("_c")).select(score, "_c.*")
    every = pairs.sparkSession.createDataFrame([(n,) for n in names], "scenario string")
    return every.join(calibrate.metrics(rows, score, "_y", by=("scenario",)), "scenario", "left").select("scenario", "log_loss", "brier", "ece")


def per_fold_best(links: DataFrame, entities: DataFrame, threshold: float, folds: list[int], grid: list[float] = decide.GRID) -> DataFrame:
    """(fold, macro_f05, own_threshold, own_f05): macro F at the global threshold, and each fold's own best one."""
    out = None
    for k in folds:
        ents = entities.where(F.col("fold") == k).select("s", "nt")
        own = decide.best_threshold(decide.sweep(links.join(ents.select("s"), "s", "left_semi"), ents, grid)).select(F.lit(k).alias("fold"), F.col("threshold").alias("own_threshold"), F.col("macro_f05").alias("own_f05"))
        out = own if out is None else out.unionByName(own)
    return per_fold(links, entities, threshold).select("fold", "macro_f05").join(out, "fold")


def holdout_policies(scored: DataFrame, truth: DataFrame, entities: DataFrame, records: DataFrame, policies: dict[str, decide.ThresholdPolicy], country: str | None = None) -> DataFrame:
    """(policy[, country], macro_f05, micro_precision, micro_recall, singleton_acc, perfect, links, gain) on a labelled hold-out.

    ``gain`` is the macro F over that of the first policy. Policies are a handful; each is one grouped job.
    """
    out = None
    for name, policy in policies.items():
        keyed = decide.class_keys(decide.link_table(scored, truth), records, policy.class_by)
        f = decide.entity_scores(keyed, entities, F.col("p") >= policy.column())
        at_least = lambda c: F.greatest(c, F.lit(1.0))
        empty = (F.col("nt") == 0).cast("double")
        rows = (f.groupBy(country) if country else f.groupBy()).agg(
            F.avg("f").alias("macro_f05"), (F.sum("tp") / at_least(F.sum("npred"))).alias("micro_precision"), (F.sum("tp") / at_least(F.sum("nt").cast("double"))).alias("micro_recall"),
            (F.sum(empty * (F.col("npred") == 0).cast("double")) / at_least(F.sum(empty))).alias("singleton_acc"), F.avg((F.col("f") == 1).cast("double")).alias("perfect"), F.sum("npred").cast("long").alias("links"),
        )
        rows = rows.withColumn("policy", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    base = out.where(F.col("policy") == next(iter(policies))).select(*([country] if country else []), F.col("macro_f05").alias("_base"))
    both = out.join(base, country) if country else out.join(base)  # a row
    return both.withColumn("gain", F.col("macro_f05") - F.col("_base")).drop("_base")


def markdown(rows: list[dict], digits: int = 5) -> str:
    """Rows of equal keys as a Markdown table."""
    if not rows:
        return ""
    spell = lambda v: f"{v:.{digits}f}" if isinstance(v, float) else "-" if v is None else str(v)
    lines = [list(rows[0]), ["-"] * len(rows[0]), *([spell(v) for v in r.values()] for r in rows)]
    return "\n".join(f"| {' | '.join(line)} |" for line in lines) + "\n"


def strongest(audit: DataFrame, k: int = 8) -> DataFrame:
    return audit.orderBy(F.desc(F.abs(F.col("auc") - 0.5)), "feature").limit(k)


def cross_fold_share(pairs: DataFrame) -> Column:
    return F.avg((F.col("s_fold") != F.col("t_fold")).cast("double"))
