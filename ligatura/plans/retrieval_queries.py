"""Queries of retrieval: features, weights, the inverted-index join, exact cosines, recall, context windows, folds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ligatura.operators import blocking, folds, pairs
from ligatura.operators.relational import gather_sides
from ligatura.plans import views as v
from ligatura.sources.files import explode_ids, id_lists

six = lambda c: (F.round(c, 6) + F.lit(0.0)).alias(c)  # no negative zero


def records_union_sources(spark, d):
    return v.records(spark, d).groupBy("src", "country").agg(F.count("*").alias("n"))


def truth_explode(spark, d):
    lists = v.truth(v.records(spark, d)).groupBy("s").agg(F.array_join(F.array_sort(F.collect_list("t")), ",").alias("ids"))
    return explode_ids(lists, "s", "ids")


def truth_id_lists(spark, d):
    rec = v.records(spark, d)
    return id_lists(rec.where("src = 1").select(F.col("entity_id").alias("s")), v.truth(rec), "matched_entity_ids")


def doc_frequency(spark, d):
    s, _, _ = v.sides(v.records(spark, d))
    return blocking.document_frequency(s)


def idf(spark, d):
    s, _, e = v.sides(v.records(spark, d))
    return blocking.idf(s, blocking.entity_counts(e)).select("country", "block", "feature", "df", six("idf"))


def block_norms(spark, d):
    s, t, e = v.sides(v.records(spark, d))
    counts = blocking.entity_counts(e)
    return blocking.block_norms(blocking.weighted(s.unionByName(t), blocking.idf(s, counts), counts)).select("id", "block", six("norm"))


def df_cap_cost(spark, d):
    s, t, _ = v.sides(v.records(spark, d))
    return blocking.cap_cost(s, t, 50)


def blocking_topk(spark, d):
    return v.candidates(spark, d).select("t", "s", six("score"), F.col("rank").cast("long").alias("rank"))


def exact_cosine(spark, d):
    ix = v.index(spark, d)
    return ix.cosines(ix.retrieve()).select("t", "s", six("cos_name"), six("cos_addr"), six("cos_cross"))


def recall_at_k(spark, d):
    rec = v.records(spark, d)
    return blocking.recall_at_k(blocking.Index(*v.sides(rec)).retrieve(), v.truth(rec), 3).select("k", six("recall"))


def candidate_tighten(spark, d):
    return blocking.tighten(v.candidates(spark, d), 2, 0.5).select("t", "s", F.col("rank").cast("long").alias("rank"))


def gather_both_sides(spark, d):
    rec = v.records(spark, d).select("entity_id", "business_name", "country")
    return gather_sides(v.candidates(spark, d).select("t", "s"), rec, "entity_id").select("t", "s", "t_business_name", "s_business_name", "s_country")


def retrieval_context(spark, d):
    ix = v.index(spark, d)
    c = pairs.context_features(ix.cosines(ix.retrieve()))
    ints = ("t_ncand", "s_ncand", "s_rank", "s_ntop1")
    return c.select("t", "s", *(F.col(i).cast("long").alias(i) for i in ints), *(six(x) for x in ("t_best", "t_second", "gap_best", "gap_second", "gap_name", "s_gap_best")))


def stage2_context(spark, d):
    rec = v.records(spark, d).select("entity_id", F.substring("business_address", 1, 2).alias("hn"))
    p = v.pairs(spark, d).withColumnRenamed("p", "p1").join(rec.toDF("t", "t_hn"), "t").join(rec.toDF("s", "s_hn"), "s")
    c = pairs.stage2_context(p)
    ints = ("c_t_prank", "c_s_prank", "c_s_n05", "c_s_n", "c_hn_same_t", "c_hn_same_s")
    return c.select("t", "s", *(F.col(i).cast("long").alias(i) for i in ints), *(six(x) for x in ("c_t_pmax", "c_t_psum", "c_t_gap", "c_t_vs_rest", "c_s_psum_other", "c_s_gap")))


def namesake_groups(spark, d):
    key = F.concat_ws("|", F.array_join(F.array_sort(F.split(F.lower("business_name"), " ")), " "), "country")
    return v.biz(spark, d).select("p_partkey", F.count("*").over(Window.partitionBy(key)).alias("n_namesakes"))


def address_crowding(spark, d):
    b = v.biz(spark, d)
    rec = b.select(
        "p_partkey", (F.col("p_partkey") % 2 + 1).cast("int").alias("src"), "country", F.regexp_extract("business_address", "^([0-9]+)", 1).alias("a_hn"),
        F.lower(F.regexp_extract("business_address", " (.*) Street", 1)).alias("a_street"), F.lower("country").alias("a_key"),
    )
    return pairs.address_crowding(rec).select("p_partkey", F.col("a_mult").cast("long").alias("a_mult"), F.col("a_smult").cast("long").alias("a_smult"))


def _entities(spark, d):
    b = v.biz(spark, d).select(F.concat(F.lit("S1-"), F.col("p_partkey").cast("string")).alias("entity_id"), F.lower("business_name").alias("group_key"), "country")
    return b


def fold_group_hash(spark, d):
    return folds.group_folds(_entities(spark, d)).select("entity_id", F.col("fold").cast("long").alias("fold"))


def fold_country(spark, d):
    return folds.country_folds(_entities(spark, d)).select("entity_id", F.col("fold").cast("long").alias("fold"))


def _record_folds(spark, d):
    rec = v.records(spark, d)
    s = folds.group_folds(rec.where("src = 1").withColumn("group_key", F.concat_ws("|", "business_name", "country")))
    return rec, s, folds.record_folds(s, rec.where("src <> 1"), v.truth(rec))


def fold_propagation(spark, d):
    _, _, f = _record_folds(spark, d)
    return folds.pair_folds(v.candidates(spark, d), f).select("t", "s", F.col("s_fold").cast("long").alias("s_fold"), F.col("t_fold").cast("long").alias("t_fold"))


def fold_isolation_audit(spark, d):
    rec, s, f = _record_folds(spark, d)
    return folds.isolation_audit(s, f, v.truth(rec))


QUERIES = {
    f.__name__: f
    for f in (
        records_union_sources, truth_explode, truth_id_lists, doc_frequency, idf, block_norms, df_cap_cost, blocking_topk, exact_cosine, recall_at_k, candidate_tighten,
        gather_both_sides, retrieval_context, stage2_context, namesake_groups, address_crowding, fold_group_hash, fold_country, fold_propagation, fold_isolation_audit,
    )
}

_COS = """,
cosines AS (
  SELECT c.t, c.s, coalesce(sum(t.w * s.w) FILTER (t.block = 'name'), 0.0) AS cos_name, coalesce(sum(t.w * s.w) FILTER (t.block = 'addr'), 0.0) AS cos_addr,
    coalesce(sum(t.w * s.w) FILTER (t.block = 'cross'), 0.0) AS cos_cross
  FROM candidates c JOIN normed t ON t.id = c.t JOIN normed s ON s.id = c.s AND s.block = t.block AND s.feature = t.feature GROUP BY 1, 2)"""
_FOLD = "CAST(('0x' || substr(md5({key} || '7'), 1, 8)) AS BIGINT) % 4"
_FOLDS = (
    ",\nsf AS (SELECT entity_id AS id, business_name || '|' || country AS group_key, " + _FOLD.format(key="business_name || '|' || country") + " AS fold FROM records WHERE src = 1),"
    "\nfolds AS (SELECT id, fold FROM sf UNION ALL SELECT r.entity_id, coalesce(f.fold, -1) FROM records r LEFT JOIN truth ON truth.t = r.entity_id LEFT JOIN sf f ON f.id = truth.s WHERE r.src <> 1)"
)
SQL = {
    "records_union_sources": f"WITH {v.RECORDS_SQL} SELECT src, country, count(*) AS n FROM records GROUP BY 1, 2",
    "truth_explode": f"WITH {v.RECORDS_SQL} SELECT s, t FROM truth",
    "truth_id_lists": f"WITH {v.RECORDS_SQL} SELECT entity_id AS source1_entity_id, coalesce(string_agg(t, ',' ORDER BY t), '') AS matched_entity_ids FROM records LEFT JOIN truth ON s = entity_id WHERE src = 1 GROUP BY 1",
    "doc_frequency": f"WITH {v.FEATURES_SQL} SELECT country, block, feature, df FROM dfs",
    "idf": f"WITH {v.FEATURES_SQL} SELECT country, block, feature, df, round(idf, 6) AS idf FROM idf",
    "block_norms": f"WITH {v.FEATURES_SQL} SELECT id, block, round(sqrt(sum(idf * idf)), 6) AS norm FROM weights GROUP BY 1, 2",
    "df_cap_cost": f"WITH {v.FEATURES_SQL}, dt AS (SELECT country, block, feature, count(*) AS df_t FROM feats WHERE src <> 1 GROUP BY ALL) SELECT country, block, count(*) AS n_features, CAST(sum(df * df_t) AS BIGINT) AS cost FROM dfs JOIN dt USING (country, block, feature) WHERE df <= 50 GROUP BY 1, 2",
    "blocking_topk": f"WITH {v.CANDIDATES_SQL} SELECT t, s, round(score, 6) AS score, rank FROM candidates",
    "exact_cosine": f"WITH {v.CANDIDATES_SQL}{_COS} SELECT t, s, round(cos_name, 6) AS cos_name, round(cos_addr, 6) AS cos_addr, round(cos_cross, 6) AS cos_cross FROM cosines",
    "recall_at_k": f"WITH {v.CANDIDATES_SQL} SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN rank < k THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS recall FROM generate_series(1, 3) g(k), truth LEFT JOIN candidates USING (t, s) GROUP BY 1",
    "candidate_tighten": f"WITH {v.CANDIDATES_SQL} SELECT t, s, rank FROM candidates WHERE rank < 2 AND score >= 0.5",
    "gather_both_sides": f"WITH {v.CANDIDATES_SQL} SELECT c.t, c.s, a.business_name AS t_business_name, b.business_name AS s_business_name, b.country AS s_country FROM candidates c JOIN records a ON a.entity_id = c.t JOIN records b ON b.entity_id = c.s",
    "retrieval_context": f"""WITH {v.CANDIDATES_SQL}{_COS}, c AS (SELECT * FROM candidates JOIN cosines USING (t, s)), w AS (
      SELECT *, max(score) OVER tt AS t_best, count(*) OVER tt AS t_ncand, max(cos_name) OVER tt AS bn, nth_value(score, 2) OVER (PARTITION BY t ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS t_second,
        count(*) OVER ss AS s_ncand, row_number() OVER (PARTITION BY s ORDER BY round(score, 9) DESC, t) AS s_rank, max(score) OVER ss AS s_best, CAST(sum(CAST(rank = 0 AS BIGINT)) OVER ss AS BIGINT) AS s_ntop1
      FROM c WINDOW tt AS (PARTITION BY t), ss AS (PARTITION BY s))
      SELECT t, s, t_ncand, s_ncand, s_rank, s_ntop1, round(t_best, 6) + 0.0::DOUBLE AS t_best, round(t_second, 6) + 0.0::DOUBLE AS t_second, round(t_best - score, 6) + 0.0::DOUBLE AS gap_best, round(score - coalesce(t_second, 0), 6) + 0.0::DOUBLE AS gap_second,
        round(bn - cos_name, 6) + 0.0::DOUBLE AS gap_name, round(s_best - score, 6) + 0.0::DOUBLE AS s_gap_best FROM w""",
    "stage2_context": f"""WITH {v.CANDIDATES_SQL}, q AS (SELECT p.t, p.s, p.p, substr(a.business_address, 1, 2) AS th, substr(b.business_address, 1, 2) AS sh FROM pairs p JOIN records a ON a.entity_id = p.t JOIN records b ON b.entity_id = p.s),
      f AS (SELECT *, CAST(p >= 0.5 AND th <> '' AS BIGINT) AS strong, CAST(p >= 0.5 AND th <> '' AND th = sh AS BIGINT) AS agree FROM q)
      SELECT t, s, row_number() OVER (PARTITION BY t ORDER BY p DESC, s) AS c_t_prank, row_number() OVER (PARTITION BY s ORDER BY p DESC, t) AS c_s_prank,
        CAST(sum(CAST(p > 0.5 AS BIGINT)) OVER ss AS BIGINT) AS c_s_n05, count(*) OVER ss AS c_s_n,
        CASE WHEN th = '' THEN -1 ELSE CAST(sum(strong) OVER (PARTITION BY s, th) - strong AS BIGINT) END AS c_hn_same_t, CASE WHEN sh = '' THEN -1 ELSE CAST(sum(agree) OVER ss - agree AS BIGINT) END AS c_hn_same_s,
        round(max(p) OVER tt, 6) AS c_t_pmax, round(sum(p) OVER tt, 6) AS c_t_psum, round(max(p) OVER tt - p, 6) AS c_t_gap, round(2 * p - sum(p) OVER tt, 6) AS c_t_vs_rest,
        round(sum(p) OVER ss - p, 6) AS c_s_psum_other, round(max(p) OVER ss - p, 6) AS c_s_gap
      FROM f WINDOW tt AS (PARTITION BY t), ss AS (PARTITION BY s)""",
    "namesake_groups": f"WITH {v.BIZ_SQL} SELECT p_partkey, count(*) OVER (PARTITION BY array_to_string(list_sort(string_split(lower(business_name), ' ')), ' ') || '|' || country) AS n_namesakes FROM biz",
    "address_crowding": f"""WITH {v.BIZ_SQL}, r AS (SELECT p_partkey, p_partkey % 2 + 1 AS src, country, regexp_extract(business_address, '^([0-9]+)', 1) AS hn, lower(regexp_extract(business_address, ' (.*) Street', 1)) AS st, lower(country) AS k FROM biz)
      SELECT p_partkey, CASE WHEN src = 1 THEN count(*) OVER (PARTITION BY src, country, hn, st, k) ELSE 0 END AS a_mult, CASE WHEN src = 1 THEN count(*) OVER (PARTITION BY src, country, st, k) ELSE 0 END AS a_smult FROM r""",
    "fold_group_hash": f"WITH {v.BIZ_SQL} SELECT 'S1-' || p_partkey AS entity_id, " + _FOLD.format(key="lower(business_name)") + " AS fold FROM biz",
    "fold_country": f"WITH {v.BIZ_SQL} SELECT 'S1-' || p_partkey AS entity_id, dense_rank() OVER (ORDER BY country) - 1 AS fold FROM biz",
    "fold_propagation": f"""WITH {v.CANDIDATES_SQL}{_FOLDS}, b AS (SELECT c.t, c.s, fs.fold AS s_fold, ft.fold AS tf, first_value(fs.fold) OVER (PARTITION BY c.t ORDER BY round(score, 9) DESC, c.s) AS bf FROM candidates c JOIN folds fs ON fs.id = c.s JOIN folds ft ON ft.id = c.t)
      SELECT t, s, s_fold, CASE WHEN tf = -1 THEN bf ELSE tf END AS t_fold FROM b""",
    "fold_isolation_audit": f"""WITH {v.RECORDS_SQL}{_FOLDS} SELECT 'groups_in_one_fold' AS "check", count(*) AS violations FROM (SELECT group_key FROM sf GROUP BY 1 HAVING count(DISTINCT fold) > 1)
      UNION ALL SELECT 'pairs_in_one_fold', count(*) FROM truth JOIN folds a ON a.id = truth.s JOIN folds b ON b.id = truth.t WHERE a.fold <> b.fold""",
}
