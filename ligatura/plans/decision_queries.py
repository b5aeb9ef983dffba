"""Queries of the decision layer: assignment, link and entity tables, sweeps, policies, calibration, evaluation, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ligatura.operators import calibrate, decide, evaluate, isolation, model, pairs, validate
from ligatura.plans import views as v
from ligatura.plans.text_queries import _SPELLED, lexicon_alignment, prepared
from ligatura.sources.files import id_lists, kept

six = lambda c: (F.round(c, 6) + F.lit(0.0)).alias(c)  # no negative zero
THRESHOLD = 0.5
GRID = [round(0.05 + 0.05 * k, 2) for k in range(19)]


def _all(spark, d):
    """(pairs, truth, entities, links, entity table)."""
    rec = v.records(spark, d)
    p, t = v.pairs(spark, d), v.truth(rec)
    e = rec.where("src = 1").select(F.col("entity_id").alias("s"), "country")
    return p, t, e, decide.link_table(p, t), decide.entity_table(e, t)


def _kept(spark, d):
    """``_all``, for queries that read its tables several times: records, pairs and truth are made once."""
    v.records(spark, d).cache()
    p, t, e, links, ents = _all(spark, d)
    return p.cache(), t.cache(), e, links, ents


def assign(spark, d):
    return decide.assign(v.pairs(spark, d), THRESHOLD).select("t", "s", six("p"))


def link_table(spark, d):
    return _all(spark, d)[3].select("t", "s", six("p"), "tp", "decoy")


def entity_scores(spark, d):
    *_, links, ents = _all(spark, d)
    return decide.entity_scores(links, ents, F.col("p") >= THRESHOLD, 2.0).select("s", "nt", "tp", "npred", six("f"))


def macro_f05(spark, d):
    p, t, e, _, _ = _all(spark, d)
    lists = lambda df: df.groupBy("s").agg(F.collect_list("t").alias("m"))
    whole = e.select("s").join(lists(t), "s", "left")
    return evaluate.macro_f(lists(decide.assign(p, THRESHOLD)), whole).select("n", *(six(c) for c in ("macro_f05", "micro_precision", "micro_recall", "singleton_acc")))


def metrics_at(spark, d):
    *_, links, ents = _all(spark, d)
    m = decide.metrics_at(links, ents, THRESHOLD, 2.0)
    return m.select("links", "n_entities", *(six(c) for c in ("macro_f05", "micro_precision", "micro_recall", "singleton_acc", "pair_accuracy")))


def metrics_by_country(spark, d):
    p, t, e, _, _ = _all(spark, d)
    lists = lambda df: df.groupBy("s").agg(F.collect_list("t").alias("m"))
    per = evaluate.per_entity(lists(decide.assign(p, THRESHOLD)), e.select("s").join(lists(t), "s", "left"))
    return evaluate.summary(per.join(e, "s"), "country").select("country", "n_entities", *(six(c) for c in ("macro_f05", "singleton_share", "micro_precision", "entities_zero")))


def threshold_sweep(spark, d):
    *_, links, ents = _all(spark, d)
    return decide.sweep(links, ents, GRID, 2.0).select("threshold", six("macro_f05"), "links", "n_tp")


def best_threshold(spark, d):
    *_, links, ents = _all(spark, d)
    return decide.best_threshold(decide.sweep(links, ents, GRID), 9).select("threshold", six("macro_f05"))


def precision_floor(spark, d):
    links = _all(spark, d)[3]
    return decide.precision_floor(links, GRID, 0.6).select("threshold", six("objective"))


def pair_level_metrics(spark, d):
    p, t, *_ = _all(spark, d)
    labelled = p.join(t.withColumn("label", F.lit(1)), ["t", "s"], "left").fillna(0, ["label"])
    return evaluate.pair_level(labelled, THRESHOLD).select(*(six(c) for c in ("accuracy", "positive_rate", "precision", "recall")))


def per_fold_metrics(spark, d):
    *_, links, ents = _all(spark, d)
    folded = ents.withColumn("fold", F.substring_index("s", "-", -1).cast("long") % 4)
    return evaluate.per_fold(links, folded, THRESHOLD).select("fold", six("macro_f05"), "n_entities")


def decoy_ratio(spark, d):
    rec = v.records(spark, d)
    half = lambda k: rec.where(F.substring_index("entity_id", "-", -1).cast("long") % 5 >= 2) if k else rec
    return decide.decoy_ratio(half(0), half(1), v.truth(rec)).select(*(six(c) for c in ("m", "decoys_train", "decoys_test", "ratio")))


def class_decoy_ratio(spark, d):
    rec = v.records(spark, d).select(F.col("entity_id").alias("id"), "src", F.col("country").alias("key"))
    test = rec.where(F.substring_index("id", "-", -1).cast("long") % 7 >= 2)
    return decide.class_decoy_ratio(rec, test, v.truth(v.records(spark, d))).select("key", six("ratio"))


def _keyed(spark, d):
    p, t, e, links, ents = _all(spark, d)
    rec = v.records(spark, d).select(F.col("entity_id").alias("id"), "src", "country")
    return decide.class_keys(links, rec, "country,src"), ents


def class_keys(spark, d):
    return _keyed(spark, d)[0].groupBy("key").agg(F.count("*").alias("n"))


def policy_thresholds(spark, d):
    policy = decide.ThresholdPolicy(0.5, {"country=en|src=2": 0.4, "country=fr|src=3": 0.7}, ["country", "src"], unseen="mean")
    rows = _keyed(spark, d)[0].withColumn("thr", policy.column())
    return rows.groupBy("key", six("thr")).agg(F.sum((F.col("p") >= F.col("thr")).cast("long")).alias("links"), F.count("*").alias("n"))


def class_report(spark, d):
    links, ents = _keyed(spark, d)
    return decide.class_report(links, ents, THRESHOLD).select("key", "n_rows", "links", six("precision"), six("recall"), six("macro_f05"), "n_entities")


def fit_class_policy(spark, d):
    """Per-class thresholds by coordinate ascent (no oracle: iterative)."""
    links, ents = _keyed(spark, d)
    policy = decide.fit_policy(links.cache(), ents.cache(), ["country", "src"], GRID, min_support=20, passes=1)
    return spark.createDataFrame(sorted(policy.thresholds.items()), "key string, threshold double")


def error_categories(spark, d):
    p, t, *_ = _all(spark, d)
    return evaluate.true_pair_outcomes(p, t, THRESHOLD).groupBy("outcome").agg(F.count("*").alias("n"))


def false_links(spark, d):
    p, t, *_ = _all(spark, d)
    return evaluate.shares(evaluate.false_links(p, t, THRESHOLD).withColumn("sure", F.col("p") > 0.8), "kind", "sure").select("kind", "n", six("sure_share"))


def robustness(spark, d):
    """Regret of the trained threshold under shifted populations (no oracle: a driver loop of checked operators)."""
    p, t, e, _, _ = _all(spark, d)
    p = p.withColumn("t_src", F.substring("t", 2, 1).cast("int")).cache()
    rows = evaluate.robustness(p, t.cache(), e.select("s").cache(), THRESHOLD, ["matched_x0.5", "singletons_x2", "source_2_only"], (2.0,))
    return spark.createDataFrame(rows, "scenario string, at_threshold double, own_threshold double, own_best double, regret double")


def submission_lists(spark, d):
    p, _, e, _, _ = _all(spark, d)
    return id_lists(e, decide.assign(p, THRESHOLD), "matched_entity_ids")


def submission_validate(spark, d):
    p, _, e, _, _ = _all(spark, d)
    lists = id_lists(e, decide.assign(p, THRESHOLD), "ids").withColumnRenamed("source1_entity_id", "s").where("s not like '%9'")
    spoiled = lists.unionByName(spark.sql("select 'S1-0' s, 'S1-3,X9,S2-1,S2-1' ids"))
    return validate.findings(spoiled, e, v.records(spark, d).where("src <> 1").select(F.col("entity_id").alias("t")))


def _labelled(spark, d):
    docs, labels = v.table(spark, d, "documents"), v.table(spark, d, "labels")
    return docs.join(labels, "doc_id").select("doc_id", F.round(F.least(F.col("n_chars") / 5000.0, F.lit(1.0)), 4).alias("p"), F.col("quality").alias("y"))


def calibration_metrics(spark, d):
    return calibrate.metrics(_labelled(spark, d), "p", "y").select(*(six(c) for c in ("log_loss", "brier", "ece")))


def prior_shift(spark, d):
    return _labelled(spark, d).select("doc_id", F.round(calibrate.shift_prior("p", 0.5), 6).alias("q"))


def platt_apply(spark, d):
    return _labelled(spark, d).select("doc_id", F.round(calibrate.apply({"method": "platt", "a": 0.8, "b": -0.1}, "p"), 6).alias("q"))


def isotonic_apply(spark, d):
    return _labelled(spark, d).select("doc_id", F.round(calibrate.apply({"method": "isotonic", "x": [0.1, 0.3, 0.6], "y": [0.2, 0.5, 0.9]}, "p"), 6).alias("q"))


def calibrators_fitted(spark, d):
    """Platt and isotonic fits of the labels on length (no oracle: iterative)."""
    rows = _labelled(spark, d).cache()
    platt, iso = calibrate.fit_platt(rows, "p", "y"), calibrate.fit_isotonic(rows, "p", "y", ["doc_id"], 50)
    return spark.createDataFrame([("platt_a", platt["a"]), ("platt_b", platt["b"]), ("isotonic_pools", float(len(iso["x"])))], "name string, value double")


def expected_f_decode(spark, d):
    """Offers accepted by expected F (no oracle: a dynamic programme; tested against enumeration)."""
    return decide.expected_f_decode(v.pairs(spark, d)).select("t", "s", six("p"))


def _features(spark, d):
    """The features of all pairs. Records and pairs are written before: their plans are long, and the driver would hold them several times."""
    v.records(spark, d).cache()
    rec = kept(prepared(spark, d).drop("business_name", "business_address", "feat_name", "feat_addr", "feat_cross"), "records")
    ix = v.index(spark, d).cached()
    found = kept(ix.cosines(ix.retrieve()), "pairs")
    ix.release()
    return pairs.features(found, rec, v.truth(v.records(spark, d)))


def pair_features(spark, d):
    """The 82 features of every candidate pair (no oracle: fuzzy scorers; tested case by case)."""
    return _features(spark, d)


def leakage_audit(spark, d):
    """Each of the 82 features' own AUC (no oracle: over the features above; the AUC operator has one)."""
    return evaluate.leakage_audit(_features(spark, d), list(pairs.STAGE_1))


def strongest_features(spark, d):
    """The features that alone tell most: the operator's own limit."""
    return evaluate.strongest(leakage_audit(spark, d))


def _ready(spark, d):
    """Pairs with features and the folds of both sides; unmatched queries have folds of their own."""
    fold = lambda c: (F.substring_index(c, "-", -1).cast("long") % 2).cast("int")
    hn = prepared(spark, d).select(F.col("entity_id").alias("id"), "a_hn")
    return _features(spark, d).withColumns({"s_fold": fold("s"), "t_fold": fold("t")}).cache(), hn


def gbt_oof(spark, d):
    """Out-of-fold scores of the cross-fitted first and second stage, at the operator's own rounds (no oracle: trained)."""
    ready, hn = _ready(spark, d)
    scored, _, _ = model.two_stages(ready, hn, [0, 1])
    return scored.select("t", "s", "label", six("p1"), six("p2"))


def feature_importance(spark, d):
    """What each feature adds to the first stage of one fold (no oracle: trained)."""
    ready, _ = _ready(spark, d)
    _, models = model.cross_fit(ready, pairs.STAGE_1, [0], 20, "p1")
    return spark.createDataFrame([(f, float(w)) for f, w in model.importance(models[0], pairs.STAGE_1)], "feature string, weight double")


def label_canary(spark, d):
    """Whether a model trained on labels shuffled within folds tells them out of fold (no oracle: trained)."""
    ready, _ = _ready(spark, d)
    auc = isolation.canary_auc(ready, pairs.STAGE_1, [0, 1], 5)
    return spark.createDataFrame([(bool(auc < isolation.CANARY_LIMIT),)], "isolated boolean")


def lexicon_isolation(spark, d):
    """Words of one fold only that stand in a lexicon learned from all folds, as if it were that fold's own."""
    counts = lexicon_alignment(spark, d)
    every = counts.select("key").distinct().join(counts.select("fold").distinct())  # a handful of folds
    return isolation.lexicon_leaks(counts, every)


def ablation(spark, d):
    """Macro F without two groups of features, few rounds, one stage (no oracle: trained)."""
    ready, hn = _ready(spark, d)
    rec = v.records(spark, d)
    e = rec.where("src = 1").select(F.col("entity_id").alias("s"))
    rows = model.ablation(ready, hn, [0, 1], v.truth(rec), e, {g: pairs.ABLATION[g] for g in ("retrieval", "strings")}, (5, 0), stage2=False)
    return spark.createDataFrame([tuple(r.values()) for r in rows], "removed string, features int, threshold double, macro_f05 double, gain double")


def holdout_policies(spark, d):
    """Two policies on the whole population as if it were the hold-out."""
    p, t, e, _, ents = _all(spark, d)
    rec = v.records(spark, d).select(F.col("entity_id").alias("id"), "src", "country")
    policies = {"base": decide.ThresholdPolicy(THRESHOLD), "by_source": decide.ThresholdPolicy(0.5, {"src=2": 0.3, "src=3": 0.7}, ["src"])}
    rows = evaluate.holdout_policies(p, t, ents, rec, policies)
    return rows.select("policy", "links", *(six(c) for c in ("macro_f05", "micro_precision", "micro_recall", "singleton_acc", "perfect", "gain")))


def calibration_under_shift(spark, d):
    """Calibration of the scores on shifted populations (no oracle: populations chosen by hash; the metrics have one)."""
    p, t, *_ = _kept(spark, d)
    p = p.withColumns({"t_src": F.substring("t", 2, 1).cast("int"), "t_indic": F.substring("t", 2, 1) == "3"})
    return evaluate.calibration_under_shift(p, t, ["matched_x0.5", "source_2_only", "indic_only"])


def nested_calibration(spark, d):
    """Calibrators fitted on other folds and applied to each (no oracle: iterative)."""
    rows = _labelled(spark, d).withColumn("fold", (F.col("doc_id") % 2).cast("int")).cache()
    out = calibrate.nested_report(rows, "p", "y", "fold", [0, 1], ["doc_id"])
    return spark.createDataFrame([(k, *map(float, (m["log_loss"], m["brier"], m["ece"]))) for k, m in out.items()], "method string, log_loss double, brier double, ece double")


def threshold_transfer(spark, d):
    """Thresholds for twice the decoys: as trained, refitted on weighted decoys, shifted by the prior."""
    p, t, e, links, ents = _kept(spark, d)
    labelled = p.join(t.withColumn("label", F.lit(1)), ["t", "s"], "left").fillna(0, ["label"])
    chosen = decide.transfer_thresholds(links, ents.select("s", "nt"), labelled, t, 2.0, GRID)
    return spark.createDataFrame(sorted(chosen.items()), "method string, threshold double")


def _nested(spark, d):
    links, ents = _keyed(spark, d)
    folded = ents.withColumn("fold", (F.substring_index("s", "-", -1).cast("long") % 2).cast("int"))
    return decide.nested_by_fold(links.withColumn("key_both", F.col("key")).cache(), folded.cache(), {"both": ["country", "src"]}, [0, 1], GRID, min_support=50, passes=1)


def nested_policies(spark, d):
    """Held-out gain of class thresholds over the global one, and on how many folds (no oracle: iterative)."""
    return decide.nested_gains(_nested(spark, d)).select("config", six("macro_f05"), six("gain"), "folds_better")


def policy_selection(spark, d):
    """The configuration that a least gain chooses (no oracle: over the iterative fits above)."""
    scores = {r["config"]: r["macro_f05"] for r in nested_policies(spark, d).collect()}  # a row a configuration
    return spark.createDataFrame([(gain, decide.select_configuration(scores, gain)) for gain in (0.0, 1e-4, 1.0)], "least_gain double, chosen string")


def per_fold_best(spark, d):
    *_, links, ents = _all(spark, d)
    folded = ents.withColumn("fold", (F.substring_index("s", "-", -1).cast("long") % 4).cast("int"))
    return evaluate.per_fold_best(links, folded, THRESHOLD, [0, 1, 2, 3], GRID).select("fold", six("macro_f05"), six("own_threshold"), six("own_f05"))


QUERIES = {
    f.__name__: f
    for f in (
        assign, link_table, entity_scores, macro_f05, metrics_at, metrics_by_country, threshold_sweep, best_threshold, precision_floor, pair_level_metrics, per_fold_metrics,
        decoy_ratio, class_decoy_ratio, class_keys, policy_thresholds, class_report, fit_class_policy, error_categories, false_links, robustness, submission_lists,
        submission_validate, calibration_metrics, prior_shift, platt_apply, isotonic_apply, calibrators_fitted, expected_f_decode, pair_features, leakage_audit, gbt_oof,
        strongest_features, feature_importance, label_canary, lexicon_isolation, ablation, holdout_policies, calibration_under_shift, nested_calibration, threshold_transfer, nested_policies,
        policy_selection, per_fold_best,
    )
}

_L = f"WITH {v.LINKS_SQL}"
_S = _L + "," + v.score_sql("0.5")
_S2 = _L + "," + v.score_sql("0.5", "2.0")
_GRID = "grid AS (SELECT round(0.05 + 0.05 * k, 2)::DOUBLE AS threshold FROM generate_series(0, 18) g(k))"
_MICRO = "sum(tp) / greatest(sum(npred), 1)"


def _sweep(weight: str) -> str:
    return f"""{_L}, {_GRID},
      sums AS (SELECT threshold, s, sum(CAST(tp AS DOUBLE)) AS tp, sum(CASE WHEN tp THEN 1.0 WHEN decoy THEN {weight} ELSE 1.0 END) AS np FROM links JOIN grid ON p >= threshold GROUP BY 1, 2),
      joined AS (SELECT g.threshold, e.s, nt, coalesce(tp, 0) AS tp, CAST(coalesce(np, 0) AS DOUBLE) AS npred FROM grid g CROSS JOIN entities e LEFT JOIN sums x ON x.s = e.s AND x.threshold = g.threshold),
      pr AS (SELECT *, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS pre, CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS rec FROM joined),
      f AS (SELECT threshold, avg(CASE WHEN nt = 0 AND npred = 0 THEN 1.0 WHEN nt = 0 THEN 0.0 WHEN pre + rec > 0 THEN 1.25 * pre * rec / (0.25 * pre + rec) ELSE 0.0 END) AS macro_f05 FROM pr GROUP BY 1),
      n AS (SELECT threshold, count(s) AS links, coalesce(CAST(sum(CAST(tp AS BIGINT)) AS BIGINT), 0) AS n_tp FROM grid LEFT JOIN links ON p >= threshold GROUP BY 1)"""


_KEYS = _L + ", keyed AS (SELECT l.*, 'country=' || b.country || '|src=' || a.src AS key FROM links l JOIN records a ON a.entity_id = l.t JOIN records b ON b.entity_id = l.s)"
_CAL = "WITH q AS (SELECT doc_id, round(least(n_chars / 5000.0::DOUBLE, 1.0), 4) AS p, quality AS y FROM documents JOIN labels USING (doc_id)), c AS (SELECT *, least(greatest(p, 1e-6), 1 - 1e-6) AS e FROM q)"
_NO = "CAST(split_part({c}, '-', 2) AS BIGINT)"
SQL = {
    "assign": _L + " SELECT t, s, p FROM best WHERE p >= 0.5",
    "link_table": _L + " SELECT t, s, p, tp, decoy FROM links",
    "entity_scores": _S2 + " SELECT s, nt, tp, npred, round(f, 6) AS f FROM scored",
    "macro_f05": _S + f" SELECT count(*) AS n, round(avg(f), 6) AS macro_f05, round({_MICRO}, 6) AS micro_precision, round(sum(tp) / greatest(sum(nt), 1), 6) AS micro_recall, round((count(*) FILTER (nt = 0 AND npred = 0)) / greatest(count(*) FILTER (nt = 0), 1), 6) AS singleton_acc FROM scored",
    "metrics_at": _S2 + ", k AS (SELECT count(*) FILTER (p >= 0.5 AND tp) AS n_tp, count(*) FILTER (p >= 0.5) AS links, avg(CASE WHEN tp = (p >= 0.5) THEN 1.0::DOUBLE ELSE 0.0 END) AS acc FROM links), e AS (SELECT avg(f) AS f, sum(nt) AS n_true, count(*) AS n, count(*) FILTER (nt = 0) AS si, count(*) FILTER (nt = 0 AND npred = 0) AS ks FROM scored) SELECT links, n AS n_entities, round(f, 6) AS macro_f05, round(n_tp / greatest(links, 1), 6) AS micro_precision, round(n_tp / greatest(n_true, 1), 6) AS micro_recall, round(ks / greatest(si, 1), 6) AS singleton_acc, round(acc, 6) AS pair_accuracy FROM e, k",
    "metrics_by_country": _S + f" SELECT country, count(*) AS n_entities, round(avg(f), 6) AS macro_f05, round(avg(CASE WHEN nt = 0 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS singleton_share, round({_MICRO}, 6) AS micro_precision, round(avg(CASE WHEN f = 0 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS entities_zero FROM scored GROUP BY 1",
    "threshold_sweep": _sweep("2.0") + " SELECT threshold, round(macro_f05, 6) AS macro_f05, links, n_tp FROM f JOIN n USING (threshold)",
    "best_threshold": _sweep("1.0") + " SELECT threshold, round(macro_f05, 6) AS macro_f05 FROM f ORDER BY round(macro_f05, 9) DESC, threshold LIMIT 1",
    "precision_floor": f"{_L}, {_GRID}, a AS (SELECT threshold, count(t) AS n, count(*) FILTER (tp) AS k FROM grid LEFT JOIN links ON p >= threshold GROUP BY 1), m AS (SELECT count(*) FILTER (NOT decoy) AS m FROM links), r AS (SELECT threshold, CASE WHEN n > 0 THEN k / n ELSE 1.0 END AS pre, k / greatest(m, 1) AS rec FROM a, m) SELECT threshold, round(CASE WHEN pre >= 0.6 THEN rec ELSE pre - 1 END, 6) + 0.0::DOUBLE AS objective FROM r",
    "pair_level_metrics": _L + ", l AS (SELECT p >= 0.5 AS h, truth.s IS NOT NULL AS y FROM pairs LEFT JOIN truth USING (t, s)) SELECT round(avg(CASE WHEN h = y THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS accuracy, round(avg(CASE WHEN y THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS positive_rate, round(count(*) FILTER (h AND y) / greatest(count(*) FILTER (h), 1), 6) AS precision, round(count(*) FILTER (h AND y) / greatest(count(*) FILTER (y), 1), 6) AS recall FROM l",
    "per_fold_metrics": _S + " SELECT " + _NO.format(c="s") + " % 4 AS fold, round(avg(f), 6) AS macro_f05, count(*) AS n_entities FROM scored GROUP BY 1",
    "decoy_ratio": f"WITH {v.RECORDS_SQL}, a AS (SELECT count(*) FILTER (src > 1) / count(*) FILTER (src = 1) AS tr, count(*) FILTER (src = 1) AS n1 FROM records), b AS (SELECT count(*) FILTER (src > 1) / count(*) FILTER (src = 1) AS te FROM records WHERE " + _NO.format(c="entity_id") + " % 5 >= 2), x AS (SELECT (SELECT count(*) FROM truth) / n1 AS m, tr, te FROM a, b) SELECT round(m, 6) AS m, round(tr - m, 6) AS decoys_train, round(te - m, 6) AS decoys_test, round(CASE WHEN tr - m > 0 THEN greatest(1.0, (te - m) / (tr - m)) ELSE 1.0 END, 6) AS ratio FROM x",
    "class_decoy_ratio": f"WITH {v.RECORDS_SQL}, a AS (SELECT country AS key, count(*) FILTER (src = 1) AS s, count(*) FILTER (src > 1) AS t FROM records GROUP BY 1), b AS (SELECT country AS key, count(*) FILTER (src = 1) AS s2, count(*) FILTER (src > 1) AS t2 FROM records WHERE " + _NO.format(c="entity_id") + " % 7 >= 2 GROUP BY 1), n AS (SELECT country AS key, count(*) AS n FROM truth JOIN records ON entity_id = s GROUP BY 1), x AS (SELECT key, t / s - coalesce(n, 0) / s AS dtr, t2 / s2 - coalesce(n, 0) / s AS dte FROM a JOIN b USING (key) LEFT JOIN n USING (key) WHERE s > 0 AND s2 > 0) SELECT key, round(CASE WHEN dtr > 0 THEN greatest(1.0, dte / dtr) ELSE 1.0 END, 6) AS ratio FROM x",
    "class_keys": _KEYS + " SELECT key, count(*) AS n FROM keyed GROUP BY 1",
    "policy_thresholds": _KEYS + ", k AS (SELECT *, CASE key WHEN 'country=en|src=2' THEN 0.4 WHEN 'country=fr|src=3' THEN 0.7 ELSE 0.55 END::DOUBLE AS thr FROM keyed) SELECT key, round(thr, 6) AS thr, count(*) FILTER (p >= thr) AS links, count(*) AS n FROM k GROUP BY 1, 2",
    "class_report": _KEYS + "," + v.score_sql("0.5") + ", e AS (SELECT key, avg(f) AS f, count(*) AS n FROM (SELECT DISTINCT key, s FROM keyed) JOIN scored USING (s) GROUP BY 1), r AS (SELECT key, count(*) AS n_rows, count(*) FILTER (p >= 0.5) AS links, count(*) FILTER (p >= 0.5 AND tp) AS k, count(*) FILTER (NOT decoy) AS m FROM keyed GROUP BY 1) SELECT key, n_rows, links, round(k / greatest(links, 1), 6) AS precision, round(k / greatest(m, 1), 6) AS recall, round(f, 6) AS macro_f05, n AS n_entities FROM r JOIN e USING (key)",
    "error_categories": _L + " SELECT CASE WHEN pairs.p IS NULL THEN 'retrieval_miss' WHEN best.s <> truth.s THEN 'outranked' WHEN best.p < 0.5 THEN 'below_threshold' ELSE 'found' END AS outcome, count(*) AS n FROM truth LEFT JOIN pairs USING (t, s) LEFT JOIN best ON best.t = truth.t GROUP BY 1",
    "false_links": _L + " SELECT CASE WHEN decoy THEN 'decoy_linked' ELSE 'wrong_entity' END AS kind, count(*) AS n, round(avg(CASE WHEN p > 0.8 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS sure_share FROM links WHERE p >= 0.5 AND NOT tp GROUP BY 1",
    "submission_lists": _L + " SELECT e.s AS source1_entity_id, coalesce(string_agg(t, ',' ORDER BY t), '') AS matched_entity_ids FROM entities e LEFT JOIN best ON best.s = e.s AND p >= 0.5 GROUP BY 1",
    "submission_validate": _L + ", li AS (SELECT e.s, list(t) FILTER (t IS NOT NULL) AS m FROM entities e LEFT JOIN best ON best.s = e.s AND p >= 0.5 WHERE e.s NOT LIKE '%9' GROUP BY 1 UNION ALL SELECT 'S1-0', ['S1-3', 'X9', 'S2-1', 'S2-1']), x AS (SELECT s, unnest(m) AS t FROM li) SELECT DISTINCT 'duplicate_row' AS \"check\", s AS id FROM li GROUP BY s HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'repeated_id', s FROM li WHERE len(m) <> len(list_distinct(m)) UNION ALL SELECT DISTINCT 'self_match', t FROM x WHERE t LIKE 'S1-%' UNION ALL SELECT DISTINCT 'wrong_prefix', t FROM x WHERE NOT regexp_matches(t, '^S[123]-') UNION ALL SELECT s, id FROM (SELECT 'missing_entity' AS s, s AS id FROM entities WHERE s NOT IN (SELECT s FROM li)) UNION ALL SELECT DISTINCT 'extra_entity', s FROM li WHERE s NOT IN (SELECT s FROM entities) UNION ALL SELECT DISTINCT 'unknown_id', t FROM x WHERE regexp_matches(t, '^S[23]-') AND t NOT IN (SELECT entity_id FROM records WHERE src <> 1)",
    "calibration_metrics": _CAL + ", a AS (SELECT avg(-(y * ln(e) + (1 - y) * ln(1 - e))) AS log_loss, avg((p - y) * (p - y)) AS brier FROM c), b AS (SELECT least(floor(p * 15), 14) AS b, count(*) AS n, avg(p) AS mp, avg(y) AS my FROM c GROUP BY 1) SELECT round(log_loss, 6) AS log_loss, round(brier, 6) AS brier, round((SELECT sum(n * abs(mp - my)) / sum(n) FROM b), 6) AS ece FROM a",
    "prior_shift": _CAL + " SELECT doc_id, round(1 / (1 + exp(-(ln(e / (1 - e)) + ln(0.5::DOUBLE)))), 6) AS q FROM c",
    "platt_apply": _CAL + " SELECT doc_id, round(1 / (1 + exp(-(0.8::DOUBLE * least(greatest(ln(e / (1 - e)), -12), 12) - 0.1))), 6) AS q FROM c",
    "isotonic_apply": _CAL + " SELECT doc_id, CASE WHEN p >= 0.6 THEN 0.9 WHEN p >= 0.3 THEN 0.5 ELSE 0.2 END::DOUBLE AS q FROM c",
    "lexicon_isolation": _SPELLED + " SELECT min(fold) AS fold, key FROM al GROUP BY key HAVING count(DISTINCT fold) = 1",
    "holdout_policies": _KEYS
    + ", lk AS (SELECT k.*, CAST(a.src AS INTEGER) AS src FROM keyed k JOIN records a ON a.entity_id = k.t), po AS (SELECT * FROM (VALUES ('base', 0.5::DOUBLE, 0.5::DOUBLE), ('by_source', 0.3::DOUBLE, 0.7::DOUBLE)) x(policy, p2, p3)), "
    "su AS (SELECT policy, s, sum(CAST(tp AS DOUBLE)) AS tp, CAST(count(*) AS DOUBLE) AS np FROM lk, po WHERE p >= CASE src WHEN 2 THEN p2 ELSE p3 END GROUP BY 1, 2), "
    "jo AS (SELECT policy, e.s, nt, coalesce(tp, 0) AS tp, coalesce(np, 0) AS np FROM po CROSS JOIN entities e LEFT JOIN su USING (policy, s)), "
    "pr AS (SELECT *, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS pre, CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS rec FROM jo), "
    "sc AS (SELECT *, CASE WHEN nt = 0 AND np = 0 THEN 1.0 WHEN nt = 0 THEN 0.0 WHEN pre + rec > 0 THEN 1.25 * pre * rec / (0.25 * pre + rec) ELSE 0.0 END AS f FROM pr), "
    "ag AS (SELECT policy, avg(f) AS f, sum(tp) / greatest(sum(np), 1) AS mp, sum(tp) / greatest(sum(nt), 1) AS mr, (count(*) FILTER (nt = 0 AND np = 0)) / greatest(count(*) FILTER (nt = 0), 1) AS sa, avg(CASE WHEN f = 1 THEN 1.0::DOUBLE ELSE 0.0 END) AS pf, CAST(sum(np) AS BIGINT) AS links FROM sc GROUP BY 1) "
    "SELECT policy, links, round(f, 6) AS macro_f05, round(mp, 6) AS micro_precision, round(mr, 6) AS micro_recall, round(sa, 6) AS singleton_acc, round(pf, 6) AS perfect, round(f - (SELECT f FROM ag WHERE policy = 'base'), 6) + 0.0::DOUBLE AS gain FROM ag",
    "per_fold_best": _sweep("1.0")
    + ", fo AS (SELECT threshold, CAST(" + _NO.format(c="s") + " % 4 AS INTEGER) AS fold, avg(CASE WHEN nt = 0 AND npred = 0 THEN 1.0 WHEN nt = 0 THEN 0.0 WHEN pre + rec > 0 THEN 1.25 * pre * rec / (0.25 * pre + rec) ELSE 0.0 END) AS f FROM pr GROUP BY 1, 2), "
    "rk AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY round(f, 12) DESC, threshold) AS rn FROM fo) "
    "SELECT a.fold, round(b.f, 6) AS macro_f05, round(a.threshold, 6) AS own_threshold, round(a.f, 6) AS own_f05 FROM rk a JOIN fo b ON b.fold = a.fold AND b.threshold = 0.5 WHERE a.rn = 1",
}
