"""Queries of the relational operators, on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ligatura.operators import relational as rel
from ligatura.plans.views import table
from ligatura.sources import files


def _load(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in names]


def join_inner(spark, d):
    o, c = _load(spark, d, "orders", "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def join_composite(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    best = li.groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("most"))
    return li.join(best, ["l_partkey", "l_suppkey"]).where("l_quantity = most").groupBy("l_suppkey").agg(F.count("*").alias("n"))


def join_left_default(spark, d):
    c, o = _load(spark, d, "customer", "orders")
    n = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return rel.left_default(c.select("c_custkey"), n, ["c_custkey"], {"n_orders": 0})


def join_semi(spark, d):
    p, li = _load(spark, d, "part", "lineitem")
    return p.join(li.where("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi").select("p_partkey", "p_brand")


def join_anti(spark, d):
    c, o = _load(spark, d, "customer", "orders")
    large = o.where("o_totalprice >= 250000").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(large, "c_custkey", "left_anti").select("c_custkey", "c_name")


def join_membership(spark, d):
    c, o = _load(spark, d, "customer", "orders")
    keys = o.where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return rel.membership(c.select("c_custkey", "c_mktsegment"), keys, "c_custkey", "big").groupBy("c_mktsegment", "big").agg(F.count("*").alias("n"))


def join_lookup_default(spark, d):
    o = table(spark, d, "orders")
    lut = spark.createDataFrame([("1-URGENT", 0.9), ("2-HIGH", 0.8)], "o_orderpriority string, thr double")
    return rel.left_default(o.select("o_orderkey", "o_orderpriority"), F.broadcast(lut), ["o_orderpriority"], {"thr": 0.5}).groupBy("o_orderpriority", "thr").agg(F.count("*").alias("n"))


def join_multiway(spark, d):
    li, o, c, n, r = _load(spark, d, "lineitem", "orders", "customer", "nation", "region")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def union_sources(spark, d):
    c, s = _load(spark, d, "customer", "supplier")
    return rel.union_all(c.select(F.lit(1).alias("src"), F.col("c_name").alias("name")), s.select(F.lit(2).alias("src"), F.col("s_name").alias("name"))).groupBy("src").agg(F.count("*").alias("n"))


def union_distinct(spark, d):
    c, s = _load(spark, d, "customer", "supplier")
    return rel.union_distinct(c.select(F.col("c_nationkey").alias("k")), s.select(F.col("s_nationkey").alias("k")))


def value_counts(spark, d):
    return rel.value_counts(table(spark, d, "events"), "event_type")


def distinct_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"), F.count("*").alias("n"))


def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


def multi_agg_conditional(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum((F.col("o_totalprice") >= 150000).cast("long")).alias("n_big"), F.max("o_orderstatus").alias("status"))


def set_collect_join(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_partkey")), ",").alias("parts"))


def mean_of_boolean(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.round(F.avg((F.col("o_totalprice") > 100000).cast("double")), 6).alias("share"))


def global_max_scalar(spark, d):
    o = table(spark, d, "orders")
    top = o.agg(F.max("o_totalprice").alias("most"))
    return o.join(top).select("o_orderkey", F.round(F.col("o_totalprice") / F.col("most"), 6).alias("share"))  # a row on the right


def weighted_bincount(spark, d):
    c, o = _load(spark, d, "customer", "orders")
    sums = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("w"))
    return rel.left_default(c.select("c_custkey"), sums, ["c_custkey"], {"w": 0.0})


def std_min_max(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.stddev_pop("l_quantity"), 6).alias("std"), F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"))


def most_common_value(spark, d):
    counts = table(spark, d, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("value")).agg(F.count("*").alias("n"))
    return rel.most_common(counts, ["o_custkey"], "value", 2, 0.3).select("o_custkey", "value", "n")


def leave_one_fold_out(spark, d):
    li = table(spark, d, "lineitem")
    counts = li.groupBy((F.col("l_orderkey") % 4).cast("int").alias("fold"), F.col("l_returnflag").alias("key")).agg(F.count("*").alias("n"))
    return rel.leave_one_fold_out(counts, counts.select("fold"), ["key"])


def context_windows(spark, d):
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey")
    return li.select(
        "l_orderkey", "l_linenumber", F.max("l_quantity").over(w).alias("best"), F.round(F.sum("l_quantity").over(w), 6).alias("total"), F.count("*").over(w).alias("n"),
        F.round(F.max("l_quantity").over(w) - F.col("l_quantity"), 6).alias("gap"),
    )


def conditional_count_window(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.sum((F.col("l_quantity") > 25).cast("long")).over(Window.partitionBy("l_suppkey", "l_returnflag")).alias("n_big"))


def ordinal_rank(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")).cast("long").alias("rank"))


def second_best(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", rel.second_best("o_totalprice", ["o_custkey"]).alias("second"))


def leave_one_out_sums(spark, d):
    li = table(spark, d, "lineitem")
    return rel.leave_one_out_sum(li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", F.col("l_linenumber").cast("long").alias("v")), ["l_suppkey", "l_returnflag"], F.col("v"), "others").select("l_orderkey", "l_linenumber", "others")


def row_index_in_group(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")) - 1).cast("long").alias("j"))


def argmax_per_key(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rel.argmax_per_key(o, ["o_custkey"], "o_totalprice", ["o_orderkey"])


def topk_per_key(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rel.top_per_key(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", F.col("rn").cast("long").alias("rn"))


def worst_examples(spark, d):
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15).select("o_orderkey", "o_totalprice")


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, item_id, a, b, common) of every document and benchmark item that share a word."""
    docs, bench = _load(spark, d, "documents", "benchmark")
    w = lambda c: F.split(F.lower(c), " ")
    return rel.overlapping(docs.select("doc_id", w("text").alias("a")), bench.select("item_id", w("text").alias("b")), "a", "b")


def list_overlap(spark, d):
    return _overlaps(spark, d).select("doc_id", "item_id", "common", (F.size(F.array_distinct("b")) - F.col("common")).alias("missing"))


def list_difference(spark, d):
    """An item's words that a document lacks which has at least half of them."""
    near = _overlaps(spark, d).where(2 * F.col("common") >= F.size(F.array_distinct("b")))
    return near.select("doc_id", "item_id", F.array_join(F.array_sort(rel.difference("b", "a")), " ").alias("missing"))


def table_columns(spark, d):
    """Names of a table's columns, from its footers alone."""
    names = files.table_columns(spark, f"{d}/documents.parquet")
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "place int, name string")


def jaccard_features(spark, d):
    c = F.col("common")
    return _overlaps(spark, d).select("doc_id", "item_id", F.round(c / F.greatest(F.size("a") + F.size("b") - c, F.lit(1)), 6).alias("jacc"), F.round(c / F.greatest(F.size("b"), F.lit(1)), 6).alias("cov"))


def equal_width_bins(spark, d):
    docs, labels = _load(spark, d, "documents", "labels")
    scored = docs.join(labels, "doc_id").select(F.least(F.col("n_chars") / 5000.0, F.lit(1.0)).alias("p"), "quality")
    return rel.equal_width_bins(scored, "p", "quality").select("bin", "n", F.round("mean_pred", 6).alias("mean_pred"), F.round("frac_pos", 6).alias("frac_pos"))


def equal_freq_bins(spark, d):
    docs, labels = _load(spark, d, "documents", "labels")
    scored = docs.join(labels, "doc_id").select("doc_id", (F.col("n_chars") / 5000.0).alias("p"), "quality")
    return rel.equal_frequency_bins(scored, "p", "quality", ["doc_id"], 10).select("bin", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "w")


def auc_rank_sum(spark, d):
    docs, labels = _load(spark, d, "documents", "labels")
    scored = docs.join(labels, "doc_id").select(F.col("n_chars").cast("double").alias("p"), "quality")
    return rel.rank_sum_auc(scored, "p", "quality").select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")


def sample_hash_range(spark, d):
    return rel.hash_range(table(spark, d, "documents"), "doc_id", 0.2, 0.5).select("doc_id")


def sample_exact_n(spark, d):
    return rel.sample_exact(table(spark, d, "documents").select("doc_id"), 100, "doc_id", "s")


def sample_bernoulli(spark, d):
    return rel.hash_range(table(spark, d, "orders"), "o_orderkey", 0.0, 0.1, "b").select("o_orderkey")


def cumulative_by_score(spark, d):
    per = table(spark, d, "lineitem").groupBy("l_quantity").agg(F.count("*").alias("n"))
    return rel.ranked_cumulative(per, "l_quantity", "n").select("l_quantity", "cum")


_SCORED = "scored AS (SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id))"
_BUCKET = "CAST(('0x' || substr(md5({v}), 1, 8)) AS BIGINT) % {n}"

QUERIES = {
    f.__name__: f
    for f in (
        join_inner, join_composite, join_left_default, join_semi, join_anti, join_membership, join_lookup_default, join_multiway, union_sources, union_distinct, value_counts,
        distinct_counts, distinct_rows, multi_agg_conditional, set_collect_join, mean_of_boolean, global_max_scalar, weighted_bincount, std_min_max, most_common_value,
        leave_one_fold_out, context_windows, conditional_count_window, ordinal_rank, second_best, leave_one_out_sums, row_index_in_group, argmax_per_key, topk_per_key,
        worst_examples, list_overlap, list_difference, table_columns, jaccard_features, equal_width_bins, equal_freq_bins, auc_rank_sum, sample_hash_range, sample_exact_n, sample_bernoulli, cumulative_by_score,
    )
}

_SHARED = """WITH d AS (SELECT doc_id, string_split(lower(text), ' ') AS w FROM documents), b AS (SELECT item_id, string_split(lower(text), ' ') AS w, len(list_distinct(w)) AS nd FROM benchmark),
  dw AS (SELECT DISTINCT doc_id, unnest(w) AS x FROM d), bw AS (SELECT DISTINCT item_id, unnest(w) AS x FROM b),
  shared AS (SELECT doc_id, item_id, count(*) AS common FROM dw JOIN bw USING (x) GROUP BY 1, 2)"""
SQL = {
    "join_inner": "SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
    "join_composite": "WITH b AS (SELECT l_partkey, l_suppkey, max(l_quantity) AS most FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, count(*) AS n FROM lineitem JOIN b USING (l_partkey, l_suppkey) WHERE l_quantity = most GROUP BY 1",
    "join_left_default": "SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1",
    "join_semi": "SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)",
    "join_anti": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice >= 250000)",
    "join_membership": "SELECT c_mktsegment, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000) AS big, count(*) AS n FROM customer GROUP BY 1, 2",
    "join_lookup_default": "SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN CAST(0.9 AS DOUBLE) WHEN '2-HIGH' THEN 0.8 ELSE 0.5 END AS thr, count(*) AS n FROM orders GROUP BY 1, 2",
    "join_multiway": "SELECT r_name, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    "union_sources": "SELECT CAST(1 AS INTEGER) AS src, count(*) AS n FROM customer UNION ALL SELECT 2, count(*) FROM supplier",
    "union_distinct": "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
    "value_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "distinct_counts": "SELECT event_type, count(DISTINCT user_id) AS n_users, count(*) AS n FROM events GROUP BY 1",
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "multi_agg_conditional": "SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_totalprice >= 150000) AS n_big, max(o_orderstatus) AS status FROM orders GROUP BY 1",
    "set_collect_join": "SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_partkey))), ',') AS parts FROM lineitem GROUP BY 1",
    "mean_of_boolean": "SELECT o_orderstatus, round(avg(CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0.0 END), 6) AS share FROM orders GROUP BY 1",
    "global_max_scalar": "SELECT o_orderkey, round(o_totalprice / (SELECT max(o_totalprice) FROM orders), 6) AS share FROM orders",
    "weighted_bincount": "SELECT c_custkey, round(coalesce(sum(o_totalprice), 0.0), 2) AS w FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1",
    "std_min_max": "SELECT l_returnflag, round(stddev_pop(l_quantity), 6) AS std, min(l_quantity) AS least, max(l_quantity) AS most FROM lineitem GROUP BY 1",
    "most_common_value": "WITH c AS (SELECT o_custkey, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1, 2), w AS (SELECT *, sum(n) OVER (PARTITION BY o_custkey) AS total, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, value) AS rn FROM c) SELECT o_custkey, value, n FROM w WHERE rn = 1 AND n >= 2 AND n >= 0.3 * total",
    "leave_one_fold_out": "WITH c AS (SELECT CAST(l_orderkey % 4 AS INTEGER) AS fold, l_returnflag AS key, count(*) AS n FROM lineitem GROUP BY 1, 2), f AS (SELECT DISTINCT fold FROM c) SELECT key, f.fold, CAST(sum(n) AS BIGINT) AS n FROM c JOIN f ON c.fold <> f.fold GROUP BY 1, 2 UNION ALL SELECT key, NULL, CAST(sum(n) AS BIGINT) FROM c GROUP BY 1",
    "context_windows": "SELECT l_orderkey, l_linenumber, max(l_quantity) OVER w AS best, round(sum(l_quantity) OVER w, 6) AS total, count(*) OVER w AS n, round(max(l_quantity) OVER w - l_quantity, 6) AS gap FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)",
    "conditional_count_window": "SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity > 25 AS BIGINT)) OVER (PARTITION BY l_suppkey, l_returnflag) AS BIGINT) AS n_big FROM lineitem",
    "ordinal_rank": "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders",
    "second_best": "SELECT o_orderkey, nth_value(o_totalprice, 2) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM orders",
    "leave_one_out_sums": "SELECT l_orderkey, l_linenumber, CAST(sum(l_linenumber) OVER (PARTITION BY l_suppkey, l_returnflag) - l_linenumber AS BIGINT) AS others FROM lineitem",
    "row_index_in_group": "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS j FROM lineitem",
    "argmax_per_key": "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1",
    "topk_per_key": "SELECT o_custkey, o_orderkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3",
    "worst_examples": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15",
    "table_columns": "SELECT CAST(ordinal_position - 1 AS INTEGER) AS place, column_name AS name FROM information_schema.columns WHERE table_name = 'documents'",
    "list_overlap": _SHARED + " SELECT doc_id, item_id, CAST(common AS INTEGER) AS common, CAST(nd - common AS INTEGER) AS missing FROM shared JOIN d USING (doc_id) JOIN b USING (item_id)",
    "list_difference": _SHARED + " SELECT doc_id, item_id, array_to_string(list_sort(list_filter(list_distinct(b.w), lambda x: NOT list_contains(d.w, x))), ' ') AS missing FROM shared JOIN d USING (doc_id) JOIN b USING (item_id) WHERE 2 * common >= nd",
    "jaccard_features": _SHARED + " SELECT doc_id, item_id, round(common / greatest(len(d.w) + len(b.w) - common, 1), 6) AS jacc, round(common / greatest(len(b.w), 1), 6) AS cov FROM shared JOIN d USING (doc_id) JOIN b USING (item_id)",
    "equal_width_bins": f"WITH {_SCORED}, s AS (SELECT least(n_chars / 5000.0::DOUBLE, 1.0) AS p, quality FROM scored) SELECT CAST(least(floor(p * 15), 14) AS BIGINT) AS bin, count(*) AS n, round(avg(p), 6) AS mean_pred, round(avg(quality), 6) AS frac_pos FROM s GROUP BY 1",
    "equal_freq_bins": f"WITH {_SCORED}, r AS (SELECT n_chars / 5000.0::DOUBLE AS p, quality, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS pos, count(*) OVER () AS n FROM scored), b AS (SELECT *, (SELECT max(j) FROM generate_series(0, 9) g(j) WHERE j * n // 10 <= pos) AS bin FROM r) SELECT bin, round(avg(p), 6) AS x, round(avg(quality), 6) AS y, count(*) AS w FROM b GROUP BY 1",
    "auc_rank_sum": f"WITH {_SCORED}, r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE AS r FROM scored), t AS (SELECT sum(r) FILTER (quality = 1) AS u, count(*) FILTER (quality = 1) AS n_pos, count(*) FILTER (quality = 0) AS n_neg FROM r) SELECT round((u - n_pos * (n_pos + 1) / 2.0::DOUBLE) / (n_pos * n_neg), 6) AS auc, n_pos, n_neg FROM t",
    "sample_hash_range": "SELECT doc_id FROM documents WHERE " + _BUCKET.format(v="CAST(doc_id AS VARCHAR)", n=1_000_000) + " BETWEEN 200000 AND 499999",
    "sample_exact_n": "SELECT doc_id FROM documents ORDER BY md5(doc_id || 's'), doc_id LIMIT 100",
    "sample_bernoulli": "SELECT o_orderkey FROM orders WHERE " + _BUCKET.format(v="o_orderkey || 'b'", n=1_000_000) + " < 100000",
    "cumulative_by_score": "SELECT l_quantity, CAST(sum(count(*)) OVER (ORDER BY l_quantity) AS BIGINT) AS cum FROM lineitem GROUP BY 1",
}
