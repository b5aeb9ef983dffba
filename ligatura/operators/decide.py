"""Decisions: one entity at most for each query record, under a global or per-class acceptance threshold.

A link table holds each query record's best candidate once: (t, s, p, tp, decoy, key). An entity table holds every entity
(s, nt) with its number of true records. A threshold sweep never joins links to the grid: links are first reduced to
counts by (s, p), and each count adds to exactly the grid points at or under its score.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ligatura.operators.relational import argmax_per_key, top_per_key

BETA2 = 0.25
GRID = [round(0.05 + 0.01 * k, 2) for k in range(94)]


def assign(pairs: DataFrame, threshold: float | Column) -> DataFrame:
    """(t, s, p) of accepted links: each query's best candidate, if its p reaches the threshold."""
    return argmax_per_key(pairs, ["t"], "p", ["s"]).where(F.col("p") >= threshold).select("t", "s", "p")


def link_table(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Each query's best candidate with tp (it is true) and decoy (the query has no true entity)."""
    best = argmax_per_key(pairs, ["t"], "p", ["s"])
    true_s = truth.groupBy("t").agg(F.min("s").alias("true_s"))
    return best.join(true_s, "t", "left").withColumns({"tp": F.coalesce(F.col("true_s") == F.col("s"), F.lit(False)), "decoy": F.col("true_s").isNull()}).drop("true_s")


def entity_table(entities: DataFrame, truth: DataFrame) -> DataFrame:
    """(s, nt) of all entities, singletons with 0."""
    n = truth.groupBy("s").agg(F.count("*").alias("nt"))
    return entities.select("s").join(n, "s", "left").select("s", F.coalesce("nt", F.lit(0)).alias("nt"))


def f_score(tp: Column, npred: Column, nt: Column, beta2: float = BETA2) -> Column:
    """F of one entity; an entity without true records scores 1 if nothing is linked to it, else 0."""
    precision = F.when(npred > 0, tp / npred).otherwise(0.0)
    recall = F.when(nt > 0, tp / nt).otherwise(0.0)
    f = F.when(precision + recall > 0, (1 + beta2) * precision * recall / (beta2 * precision + recall)).otherwise(0.0)
    return F.when((nt == 0) & (npred == 0), 1.0).when(nt == 0, 0.0).otherwise(f)


def entity_scores(links: DataFrame, entities: DataFrame, accepted: Column, decoy_weight: float | Column = 1.0, beta2: float = BETA2) -> DataFrame:
    """(s, nt, tp, npred, f) of every entity; accepted links to decoys weigh ``decoy_weight``."""
    w = F.when(F.col("tp"), 1.0).when(F.col("decoy"), decoy_weight if isinstance(decoy_weight, Column) else F.lit(float(decoy_weight))).otherwise(1.0)
    sums = links.where(accepted).groupBy("s").agg(F.sum(F.col("tp").cast("double")).alias("tp"), F.sum(w).alias("npred"))
    all_of = entities.join(sums, "s", "left").fillna(0.0, ["tp", "npred"])
    return all_of.withColumn("f", f_score(F.col("tp"), F.col("npred"), F.col("nt"), beta2))


def metrics_at(links: DataFrame, entities: DataFrame, threshold: float | Column, decoy_weight: float | Column = 1.0) -> DataFrame:
    """One row: macro F0.5, micro precision and recall, singleton accuracy, links, pair accuracy, entities."""
    accepted = F.col("p") >= threshold
    e = entity_scores(links, entities, accepted, decoy_weight).agg(
        F.avg("f").alias("macro_f05"), F.sum("nt").alias("n_true"), F.sum((F.col("nt") == 0).cast("long")).alias("singles"),
        F.sum(((F.col("nt") == 0) & (F.col("npred") == 0)).cast("long")).alias("kept_single"), F.count("*").alias("n_entities"),
    )
    k = links.agg(
        F.coalesce(F.sum((accepted & F.col("tp")).cast("long")), F.lit(0)).alias("n_tp"), F.coalesce(F.sum(accepted.cast("long")), F.lit(0)).alias("links"),
        F.avg((F.col("tp") == accepted).cast("double")).alias("pair_accuracy"),
    )
    both = e.join(k)  # one row each
    at_least = lambda c: F.greatest(F.col(c), F.lit(1))
    return both.select(
        "macro_f05", (F.col("n_tp") / at_least("links")).alias("micro_precision"), (F.col("n_tp") / at_least("n_true")).alias("micro_recall"),
        (F.col("kept_single") / at_least("singles")).alias("singleton_acc"), "links", "pair_accuracy", "n_entities",
    )


def grid_place(grid: list[float]) -> Column:
    """The number of the last point of an even grid at or under p; -1 under all."""
    crossing = F.floor((F.col("p") - grid[0]) / (grid[1] - grid[0]) + 1e-6).cast("int")
    at = F.least(crossing, F.lit(len(grid) - 1))
    g = F.array(*map(F.lit, grid))
    return F.when((at >= 0) & (F.get(g, at) > F.col("p")), at - 1).when((at + 1 < len(grid)) & (F.get(g, at + 1) <= F.col("p")), at + 1).otherwise(at)


def sweep(links: DataFrame, entities: DataFrame, grid: list[float] = GRID, decoy_weight: float = 1.0, beta2: float = BETA2) -> DataFrame:
    """(threshold, macro_f05, links, n_tp) at every grid point.

    An entity's score only changes at the grid points that its own links cross, so each entity gives as many rows as it
    has distinct crossings, with the change of its F there; a running sum over the grid does the rest.
    """
    exact = grid_place(grid)
    w = F.when(F.col("tp"), 1.0).when(F.col("decoy"), F.lit(float(decoy_weight))).otherwise(1.0)
    counts = links.withColumn("g", exact).where("g >= 0").groupBy("s", "g").agg(F.sum(F.col("tp").cast("double")).alias("tp"), F.sum(w).alias("np"), F.count("*").alias("n"), F.sum(F.col("tp").cast("long")).alias("k"))
    down = Window.partitionBy("s").orderBy(F.desc("g"))
    run = counts.join(entities, "s").withColumns({"cum_tp": F.sum("tp").over(down), "cum_np": F.sum("np").over(down)})
    now = f_score(F.col("cum_tp"), F.col("cum_np"), F.col("nt"), beta2)
    before = F.coalesce(F.lag(now).over(down), F.when(F.col("nt") == 0, 1.0).otherwise(0.0))
    steps = run.select("g", (now - before).alias("d"), "n", "k").groupBy("g").agg(F.sum("d").alias("d"), F.sum("n").alias("n"), F.sum("k").alias("k"))
    base = entities.agg(F.count("*").alias("n_entities"), F.sum((F.col("nt") == 0).cast("double")).alias("empty_f"))
    points = links.sparkSession.createDataFrame([(i, t) for i, t in enumerate(grid)], "g int, threshold double")
    # a row a grid point from here on
    above = Window.orderBy(F.desc("g"))
    out = points.join(F.broadcast(steps), "g", "left").fillna(0).withColumns({c: F.sum(c).over(above) for c in ("d", "n", "k")})
    return out.join(base).select("threshold", ((F.col("empty_f") + F.col("d")) / F.col("n_entities")).alias("macro_f05"), F.col("n").cast("long").alias("links"), F.col("k").cast("long").alias("n_tp"))


def best_threshold(rows: DataFrame, digits: int = 12) -> DataFrame:
    """The sweep's row of highest macro F; ties to the lowest threshold."""
    return rows.orderBy(F.desc(F.round("macro_f05", digits)), F.asc("threshold")).limit(1)


# --------------------------------------------------------------------- transfer


def decoy_ratio(train: DataFrame, test: DataFrame, n_true: DataFrame) -> DataFrame:
    """(m, decoys_train, decoys_test, ratio) from tables of records with ``src`` and the true pairs of training."""
    share = lambda df: df.agg((F.sum((F.col("src") > 1).cast("double")) / F.sum((F.col("src") == 1).cast("double"))).alias("x"), F.sum((F.col("src") == 1).cast("double")).alias("n"))
    tr, te = share(train).toDF("tr", "n1"), share(test).toDF("te", "n1_te")
    one = tr.join(te).join(n_true.agg(F.count("*").alias("pairs")))  # a row each
    m = F.col("pairs") / F.col("n1")
    d_tr, d_te = F.col("tr") - m, F.col("te") - m
    return one.select(m.alias("m"), d_tr.alias("decoys_train"), d_te.alias("decoys_test"), F.when(d_tr > 0, F.greatest(F.lit(1.0), d_te / d_tr)).otherwise(1.0).alias("ratio"))


def class_decoy_ratio(train: DataFrame, test: DataFrame, truth: DataFrame) -> DataFrame:
    """(key, ratio) of each class from records (key, src, id); a class that one side lacks is left out (global ratio)."""

    def sums(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("key").agg(F.sum((F.col("src") == 1).cast("double")).alias(f"s_{name}"), F.sum((F.col("src") > 1).cast("double")).alias(f"t_{name}"))

    pairs = truth.join(train.where("src = 1").select(F.col("id").alias("s"), "key"), "s").groupBy("key").agg(F.count("*").alias("pairs"))
    both = sums(train, "tr").join(sums(test, "te"), "key").join(pairs, "key", "left").fillna(0, ["pairs"]).where("s_tr > 0 and s_te > 0")
    m = F.col("pairs") / F.col("s_tr")
    d_tr, d_te = F.col("t_tr") / F.col("s_tr") - m, F.col("t_te") / F.col("s_te") - m
    return both.select("key", F.when(d_tr > 0, F.greatest(F.lit(1.0), d_te / d_tr)).otherwise(1.0).alias("ratio"))


def transfer_thresholds(links: DataFrame, entities: DataFrame, pairs: DataFrame, truth: DataFrame, ratio: float, grid: list[float] = GRID) -> dict[str, float]:
    """Thresholds for data with ``ratio`` times the decoys: as trained, refitted with weighted decoys, or shifted by the prior."""
    from ligatura.operators.calibrate import inverse_shift

    plain = best_threshold(sweep(links, entities, grid)).first()["threshold"]
    dense = best_threshold(sweep(links, entities, grid, ratio)).first()["threshold"]
    n = pairs.join(truth.select("t").distinct().withColumn("matched", F.lit(True)), "t", "left").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"), F.sum(F.col("matched").isNull().cast("int")).alias("decoys")
    ).first()
    odds = n["neg"] / (n["neg"] + (ratio - 1) * n["decoys"]) if n["neg"] else 1.0
    return {"train": plain, "density": dense, "prior": round(inverse_shift(plain, odds), 4)}


# --------------------------------------------------------------------- policies



def attribute(name: str) -> tuple[str, Column]:
    flag = lambda c: c.cast("int").cast("string")
    none = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    table = {
        "country": lambda: ("s", F.coalesce("country", F.lit(""))), "src": lambda: ("t", F.col("src").cast("string")), "indic": lambda: ("t", flag(F.col("f_indic"))),
        "alias": lambda: ("t", flag(F.col("f_alias"))), "noaddr": lambda: ("t", flag(none("a_norm"))), "s_noaddr": lambda: ("s", flag(none("a_norm"))),
        "domain": lambda: ("t", flag(~none("n_domain"))),
    }
    if name not in table:
        raise ValueError(f"unknown class attribute {name!r}; known: {sorted(table)}")
    return table[name]()


def parse_class_by(spec: str | list[str] | None) -> list[str]:
    names = [x for x in spec.replace("|", ",").split(",") if x] if isinstance(spec, str) else list(spec or [])
    known = {"country", "src", "indic", "alias", "noaddr", "s_noaddr", "domain"}
    if bad := [n for n in names if n not in known]:
        raise ValueError(f"unknown class attributes {bad}; known: {sorted(known)}")
    return names


def class_keys(pairs: DataFrame, records: DataFrame, class_by: str | list[str]) -> DataFrame:
    """``pairs`` with ``key``: ``a=v|b=w`` over the attributes, read from the entity's or the query's record."""
    names = parse_class_by(class_by)
    if not names:
        return pairs.withColumn("key", F.lit(""))
    out = pairs
    for side, of in (("s", [n for n in names if attribute(n)[0] == "s"]), ("t", [n for n in names if attribute(n)[0] == "t"])):
        if of:
            out = out.join(records.select(F.col("id").alias(side), *(attribute(n)[1].alias(f"_{n}") for n in of)), side, "left")
    key = F.concat_ws("|", *(F.concat(F.lit(f"{n}="), F.coalesce(F.col(f"_{n}"), F.lit(""))) for n in names))
    return out.withColumn("key", key).drop(*(f"_{n}" for n in names))


@dataclass
class ThresholdPolicy:
    """One threshold, or one for each class with a fallback for classes not seen: default, max, min or mean."""

    default: float
    thresholds: dict[str, float] = field(default_factory=dict)
    class_by: list[str] = field(default_factory=list)
    scale: str = "calibrated"
    unseen: str = "default"
    name: str = "global"
    fit: dict = field(default_factory=dict)

    @property
    def scheme(self) -> str:
        return "per_class" if self.thresholds else "global"

    def fallback(self) -> float:
        values = list(self.thresholds.values())
        if not values or self.unseen == "default":
            return self.default
        return {"max": max, "min": min, "mean": lambda v: sum(v) / len(v)}[self.unseen](values)

    def column(self, key: str = "key") -> Column:
        """The threshold of each row by its class key: a literal map, as policies hold a handful of classes."""
        if not self.thresholds:
            return F.lit(self.default)
        table = F.create_map(*(F.lit(x) for kv in sorted(self.thresholds.items()) for x in kv))
        return F.coalesce(F.try_element_at(table, F.col(key)), F.lit(self.fallback()))

    def to_json(self) -> str:
        return json.dumps({"version": 1, "name": self.name, "scheme": self.scheme, "scale": self.scale, "class_by": self.class_by, "default": self.default, "unseen": self.unseen, "thresholds": dict(sorted(self.thresholds.items())), "fit": self.fit}, indent=1)

    @classmethod
    def from_json(cls, text: str) -> ThresholdPolicy:
        d = json.loads(text)
        return cls(d["default"], d.get("thresholds") or {}, d.get("class_by") or [], d.get("scale", "calibrated"), d.get("unseen", "default"), d.get("name") or "global", d.get("fit") or {})


def class_sweep(links: DataFrame, entities: DataFrame, key: str, policy: ThresholdPolicy, grid: list[float], decoy_weight: float = 1.0, beta2: float = BETA2) -> list[tuple[float, float]]:
    """(threshold, macro F) of one class's thresholds, all others fixed: one job, the other classes' sums being constant."""
    others = (F.col("key") != key) & (F.col("p") >= policy.column())
    w = F.when(F.col("tp"), 1.0).when(F.col("decoy"), F.lit(float(decoy_weight))).otherwise(1.0)
    fixed = links.where(others).groupBy("s").agg(F.sum(F.col("tp").cast("double")).alias("tp0"), F.sum(w).alias("np0"))
    mine = links.where(F.col("key") == key)
    per = mine.groupBy("s").agg(F.collect_list(F.struct("p", F.col("tp").cast("double").alias("tp"), w.alias("w"))).alias("own"))
    e = entities.join(fixed, "s", "left").join(per, "s", "left").fillna(0.0, ["tp0", "np0"])

    def f_at(t: float) -> Column:
        kept = F.filter(F.coalesce("own", F.expr("cast(array() as array<struct<p:double,tp:double,w:double>>)")), lambda x: x["p"] >= t)
        total = lambda name: F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x[name])
        return F.avg(f_score(F.col("tp0") + total("tp"), F.col("np0") + total("w"), F.col("nt"), beta2))

    touched = e.where(F.col("own").isNotNull())
    rest = e.where(F.col("own").isNull()).agg(F.sum(f_score(F.col("tp0"), F.col("np0"), F.col("nt"), beta2)).alias("f"), F.count("*").alias("n")).first()
    row = touched.agg(F.count("*").alias("n"), *(f_at(t).alias(f"g{i}") for i, t in enumerate(grid))).first()
    n = row["n"] + rest["n"]
    return [(t, ((row[f"g{i}"] or 0.0) * row["n"] + (rest["f"] or 0.0)) / max(n, 1)) for i, t in enumerate(grid)]


def fit_policy(links: DataFrame, entities: DataFrame, class_by: list[str], grid: list[float] = GRID, decoy_weight: float = 1.0, beta: float = 0.5, min_support: int = 200, passes: int = 4, unseen: str = "default", name: str | None = None) -> ThresholdPolicy:
    """A global threshold and, with classes (column ``key``), one for each by coordinate ascent from the global one.

    Classes that touch fewer than ``min_support`` entities keep the global threshold; ties go to the threshold nearest to
    it. ``links`` should be written or cached: every sweep reads it.
    """
    beta2 = beta * beta
    start = best_threshold(sweep(links, entities, grid, decoy_weight, beta2)).first()["threshold"]
    policy = ThresholdPolicy(start, class_by=list(class_by), unseen=unseen, name=name or ("|".join(class_by) or "global"), fit={"beta": beta, "global_threshold": start, "min_support": min_support})
    if not class_by:
        return policy
    support = {r["key"]: r["n"] for r in links.groupBy("key").agg(F.countDistinct("s").alias("n")).collect()}  # a row a class
    policy.thresholds = dict.fromkeys(support, start)
    for _ in range(passes):
        changed = False
        for key in sorted(k for k, n in support.items() if n >= min_support):
            rows = class_sweep(links, entities, key, policy, grid, decoy_weight, beta2)
            top = max(v for _, v in rows)
            best = min((t for t, v in rows if v >= top - 1e-12), key=lambda t: (abs(t - start), -t))
            changed |= abs(best - policy.thresholds[key]) > 1e-12
            policy.thresholds[key] = best
        if not changed:
            break
    policy.fit["support"] = support
    return policy


def class_report(links: DataFrame, entities: DataFrame, threshold: float | Column, decoy_weight: float = 1.0) -> DataFrame:
    """By class key: rows, accepted links, link precision and recall, and macro F over the entities the class touches."""
    accepted = F.col("p") >= threshold
    scores = entity_scores(links, entities, accepted, decoy_weight).select("s", "f")
    touched = links.select("key", "s").distinct().join(scores, "s").groupBy("key").agg(F.avg("f").alias("macro_f05"), F.count("*").alias("n_entities"))
    n_tp, n = F.sum((accepted & F.col("tp")).cast("long")), F.sum(accepted.cast("long"))
    rows = links.groupBy("key").agg(
        F.count("*").alias("n_rows"), n.alias("links"), (n_tp / F.greatest(n, F.lit(1))).alias("precision"),
        (n_tp / F.greatest(F.sum((~F.col("decoy")).cast("long")), F.lit(1))).alias("recall"),
    )
    return rows.join(touched, "key")


def precision_floor(links: DataFrame, grid: list[float], floor: float = 0.999) -> DataFrame:
    """(threshold, objective): link recall where link precision reaches the floor, else precision - 1."""
    points = links.sparkSession.createDataFrame([(i, t) for i, t in enumerate(grid)], "g int, threshold double")
    counts = links.withColumn("g", grid_place(grid)).groupBy("g").agg(F.count("*").alias("n"), F.sum(F.col("tp").cast("long")).alias("k"), F.sum((~F.col("decoy")).cast("long")).alias("m"))
    total = counts.agg(F.sum("m").alias("all_m"))
    # a row a grid point from here on
    above = Window.orderBy(F.desc("g"))
    sums = points.join(F.broadcast(counts.drop("m")), "g", "left").fillna(0, ["n", "k"]).withColumns({c: F.sum(c).over(above) for c in "nk"})
    all_points = sums.join(total)
    precision = F.when(F.col("n") > 0, F.col("k") / F.col("n")).otherwise(1.0)
    recall = F.col("k") / F.greatest(F.coalesce("all_m", F.lit(0)), F.lit(1))
    return all_points.select("threshold", F.when(precision >= floor, recall).otherwise(precision - 1).alias("objective"))


def nested_by_fold(links: DataFrame, entities: DataFrame, configs: dict[str, list[str]], folds: list[int], grid: list[float] = GRID, **fit) -> DataFrame:
    """(config, fold, macro_f05, n): held-out macro F, fitted on the entities of the other folds, applied to each fold.

    ``links`` needs one class key column ``key_<name>`` for each configuration. A few jobs a fold and configuration.
    """
    out = None
    for name, class_by in {"global": [], **configs}.items():
        keyed = links.withColumn("key", F.col(f"key_{name}") if class_by else F.lit(""))
        for k in folds:
            rest = entities.where(F.col("fold") != k)
            policy = fit_policy(keyed.join(rest.select("s"), "s", "left_semi"), rest.select("s", "nt"), class_by, grid, **fit)
            held = entities.where(F.col("fold") == k).select("s", "nt")
            scores = entity_scores(keyed.join(held.select("s"), "s", "left_semi"), held, F.col("p") >= policy.column())
            row = scores.agg(F.lit(name).alias("config"), F.lit(k).alias("fold"), F.avg("f").alias("macro_f05"), F.count("*").alias("n"))
            out = row if out is None else out.unionByName(row)
    return out


def nested_gains(by_fold: DataFrame) -> DataFrame:
    """(config, macro_f05, gain, folds_better) over all held-out entities, against the global threshold."""
    base = by_fold.where("config = 'global'").select("fold", F.col("macro_f05").alias("base"))
    both = by_fold.where("n > 0").join(base, "fold")
    mean = lambda c: F.sum(F.col(c) * F.col("n")) / F.sum("n")
    return both.groupBy("config").agg(mean("macro_f05").alias("macro_f05"), (mean("macro_f05") - mean("base")).alias("gain"), F.sum((F.col("macro_f05") > F.col("base")).cast("long")).alias("folds_better"))


def nested_comparison(links: DataFrame, entities: DataFrame, configs: dict[str, list[str]], folds: list[int], grid: list[float] = GRID, **fit) -> dict[str, float]:
    """Held-out macro F of the global threshold and of each configuration."""
    return {r["config"]: r["macro_f05"] for r in nested_gains(nested_by_fold(links, entities, configs, folds, grid, **fit)).collect()}  # a row a configuration


def select_configuration(scores: dict[str, float], least_gain: float = 1e-4) -> str:
    """The best configuration that beats the global one by ``least_gain``, else the global one."""
    best = max(scores, key=lambda k: (scores[k], k == "global"))
    return best if scores[best] - scores["global"] >= least_gain else "global"


# --------------------------------------------------------------------- decoding


def best_prefix(q: list[float], miss: float = 0.0, beta2: float = BETA2) -> int:
    """How many of the offers ``q`` (descending probabilities) to accept for the highest expected F."""

    def distribution(values: list[float]) -> list[float]:
        d = [1.0]
        for p in values:
            d = [(d[i] if i < len(d) else 0.0) * (1 - p) + (d[i - 1] * p if i else 0.0) for i in range(len(d) + 1)]
        return d

    best, best_value = 0, math.exp(-miss) * math.prod(1 - p for p in q)
    for k in range(1, len(q) + 1):
        tp, fn = distribution(q[:k]), distribution(q[k:])
        value = sum(x * y * (1 + beta2) * a / (beta2 * (a + b + miss) + k) for a, x in enumerate(tp) for b, y in enumerate(fn))
        if value > best_value:
            best, best_value = k, value
    return best


def expected_f_decode(pairs: DataFrame, max_offers: int = 12, miss: float = 0.0, min_q: float = 0.02) -> DataFrame:
    """(t, s, p): each entity accepts the prefix of its offers that maximises its expected F.

    Offers are each query's best candidate; an entity's are cut to ``max_offers`` before they are gathered, so each list is short.
    """

    @F.pandas_udf(LongType())
    def prefix(q: pd.Series) -> pd.Series:
        return pd.Series([best_prefix([float(x) for x in v], miss) for v in q])

    offers = argmax_per_key(pairs, ["t"], "p", ["s"]).where(F.col("p") >= min_q).select("t", "s", "p")
    top = top_per_key(offers, ["s"], [F.desc("p"), F.asc("t")], max_offers, "j")
    lists = top.groupBy("s").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "p"))), lambda x: x["p"]).alias("q"))
    return top.join(lists.select("s", prefix("q").alias("k")), "s").where("j <= k").select("t", "s", "p")
