"""Queries of text normalisation, similarity and the lexicons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.functions import similarity as sim
from ligatura.functions import textnorm as tn
from ligatura.operators import lexicon
from ligatura.plans import views as v


def prepared(spark: SparkSession, d: str) -> DataFrame:
    """``records`` with the 17 normalised fields."""
    return tn.normalize(v.records(spark, d).drop("h"), "business_name", "business_address", "country")


def norm_tokens(spark, d):
    return v.biz(spark, d).select("p_partkey", F.array_join(tn.latin_tokens(tn.to_ascii("business_name")), " ").alias("tokens"))


def norm_name(spark, d):
    """Normalised names (no oracle: contextual folds; tested case by case)."""
    return v.biz(spark, d).select("p_partkey", tn.norm_name("business_name", "country").alias("n")).select("p_partkey", "n.*")


def norm_addr(spark, d):
    """Normalised addresses (no oracle: table-driven; tested case by case)."""
    return v.biz(spark, d).select("p_partkey", tn.norm_address("business_address", "country").alias("a")).select("p_partkey", "a.*")


def blocking_feature_strings(spark, d):
    """Blocking features of normalised records (no oracle: built on the two above)."""
    b = tn.normalize(v.biz(spark, d), "business_name", "business_address", "country")
    return b.select("p_partkey", *(F.array_join(c, " ").alias(c) for c in ("feat_name", "feat_addr", "feat_cross")))


def records_prepared(spark, d):
    """Every record normalised (no oracle)."""
    return prepared(spark, d).select("entity_id", "n_full", "n_core", "a_norm", "a_hn", F.size("feat_name").alias("n_features"))


def phonetic_skeleton(spark, d):
    w = v.table(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("word")).distinct()
    return w.select("word", tn.skeleton("word").alias("skeleton"))


def domain_extract(spark, d):
    """The name that a web address stands for, by the name normalisation."""
    host = F.regexp_extract("url", "^https?://([^/?#.]+)", 1)
    ends = F.array(*map(F.lit, (".com", ".co.in", ".fr", " inc", "")))
    name = F.concat(F.when(F.col("page_id") % 2 == 0, "https://www.x").otherwise("x"), host, F.element_at(ends, (F.col("page_id") % 5 + 1).cast("int")))
    return v.table(spark, d, "pages").select("page_id", tn.norm_name(name, F.lit(""))["n_domain"].alias("domain"))


def alias_parts(spark, d):
    """One to three names in one field."""
    k = F.col("p_partkey") % 4
    x = F.when(k == 1, F.concat("business_name", F.lit(" DBA: "), "country")).when(k == 2, F.concat("business_name", F.lit(" | "), "country", F.lit(" formerly "), F.col("p_partkey").cast("string")))
    b = v.biz(spark, d).withColumn("x", F.when(k == 3, F.concat(F.lit("(ID: 7) "), "business_name")).otherwise(F.coalesce(x, "business_name")))
    parts = tn.alias_parts("x")
    return b.select("p_partkey", F.size(parts).alias("n_parts"), F.trim(F.element_at(parts, 1)).alias("first"), F.trim(F.element_at(parts, -1)).alias("last"))


def indic_predicate(spark, d):
    b = v.biz(spark, d).withColumn("x", F.when(F.col("p_partkey") % 3 == 0, F.concat("business_name", F.lit(" राम"))).otherwise(F.col("business_name")))
    return b.groupBy(tn.is_indic("x").alias("indic")).agg(F.count("*").alias("n"))


def _names(spark, d):
    p = v.table(spark, d, "part").select(F.lower("p_name").alias("n")).distinct()
    return p.alias("a").join(p.alias("b"), F.col("a.n") < F.col("b.n")).select(F.col("a.n").alias("a"), F.col("b.n").alias("b"))  # 64 names


def sim_indel_ratio(spark, d):
    """Indel ratio of name pairs (tested against its definition)."""
    return _names(spark, d).select("a", "b", F.round(sim.ratio("a", "b"), 6).alias("ratio"))


def sim_indel_native(spark, d):
    """The same without a Python worker."""
    return _names(spark, d).select("a", "b", F.round(sim.ratio_native(F.col("a"), F.col("b")), 6).alias("ratio"))


def sim_token_sort(spark, d):
    return _names(spark, d).select("a", "b", F.round(sim.token_sort_ratio("a", "b"), 6).alias("ratio"))


def sim_token_set(spark, d):
    return _names(spark, d).select("a", "b", F.round(sim.token_set_ratio("a", "b"), 6).alias("ratio"))


def sim_partial(spark, d):
    return _names(spark, d).select("a", "b", F.round(sim.partial_ratio_column("a", "b"), 6).alias("ratio"))


def sim_jaro_winkler(spark, d):
    return _names(spark, d).select("a", "b", F.round(sim.jaro_winkler("a", "b"), 6).alias("jw"))


def hn_relation(spark, d):
    o = v.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 1500).cast("string").alias("a"), (F.col("o_custkey") % 150).cast("string").alias("b"))
    return o.select("o_orderkey", sim.house_number_relation("a", "b").alias("rel"))


def tok_unmatched(spark, d):
    """Tokens without a like (tested by hand-made cases)."""
    return _names(spark, d).select("a", "b", sim.tokens_unmatched("a", "b").alias("n"))


def _spelled(spark, d):
    """Words of another script aligned with Latin ones: the fixture has none, so digits stand for letters of that script."""
    word = F.translate(F.col("p_partkey").cast("string"), "0123456789", "".join(chr(0x0915 + k) for k in range(10)))
    b = v.biz(spark, d)
    return b.select((F.col("p_partkey") % 4).cast("int").alias("fold"), F.concat(word.substr(1, 2), F.lit(" "), F.split("business_name", " ")[1]).alias("t_name"), F.concat_ws(" ", F.split("business_name", " ")[0], F.split("business_name", " ")[1]).alias("s_name"))


def lexicon_alignment(spark, d):
    return lexicon.name_alignments(_spelled(spark, d))


def lexicon_loo(spark, d):
    counts = lexicon.name_alignments(_spelled(spark, d))
    return lexicon.fold_lexicons(counts, counts.select("fold"), 2, 0.1)


def transliterated(spark, d):
    """Names and components of another script by the lexicon of all folds."""
    b = _spelled(spark, d)
    counts = lexicon.name_alignments(b)
    entries = lexicon.as_map(lexicon.fold_lexicons(counts, counts.select("fold"), 2, 0.1), None)
    word = F.split("t_name", " ")[0]
    return b.select(tn.transliterate_words("t_name", entries).alias("words"), tn.transliterate_component(word, entries).alias("component"))


def address_cooccurrence(spark, d):
    """How often components of another script meet an entity's address components."""
    word = F.translate(F.col("p_partkey").cast("string"), "0123456789", "".join(chr(0x0915 + k) for k in range(10))).substr(1, 1)
    b = v.biz(spark, d).select((F.col("p_partkey") % 4).cast("int").alias("fold"), F.concat(word, F.lit(", "), "country").alias("t_addr"), F.col("business_address").alias("s_addr"))
    return lexicon.address_cooccurrences(b)[0]


QUERIES = {
    f.__name__: f
    for f in (
        norm_tokens, norm_name, norm_addr, blocking_feature_strings, records_prepared, phonetic_skeleton, domain_extract, alias_parts, indic_predicate, sim_indel_ratio,
        sim_indel_native, sim_token_sort, sim_token_set, sim_partial, sim_jaro_winkler, hn_relation, tok_unmatched, lexicon_alignment, lexicon_loo, transliterated, address_cooccurrence,
    )
}

_SKELETON = "lower(word)"
for _p, _r in tn.SKELETON_RULES:
    if "(?=" in _p:  # the oracle's regular expressions have no lookahead
        _SKELETON = f"regexp_replace({_SKELETON}, 'c([eiy])', 's\\1', 'g')"
    else:
        _SKELETON = f"regexp_replace({_SKELETON}, '{_p}', '{_r.replace('$1', chr(92) + '1')}', 'g')"
_MAP = "translate(CAST(p_partkey AS VARCHAR), '0123456789', '" + "".join(chr(0x0915 + k) for k in range(10)) + "')"
_SPELLED = f"""WITH {v.BIZ_SQL}, sp AS (SELECT CAST(p_partkey % 4 AS INTEGER) AS fold, substr({_MAP}, 1, 2) AS key, lower(string_split(business_name, ' ')[1]) AS value FROM biz),
  al AS (SELECT fold, key, value, count(*) AS n FROM sp GROUP BY 1, 2, 3)"""
_REPEAT = "list_reduce(list_prepend('', string_split({x}, '')), lambda acc, c: CASE WHEN right(acc, 1) = c THEN acc ELSE acc || c END)"
_N = "WITH p AS (SELECT DISTINCT lower(p_name) AS n FROM part), q AS (SELECT a.n AS a, b.n AS b FROM p a JOIN p b ON a.n < b.n)"
#: Longest common subsequences of x and y of all name pairs, a row of the table for each character of x.
_LCS = """WITH RECURSIVE p AS (SELECT DISTINCT lower(p_name) AS n FROM part), q AS (SELECT a.n AS a, b.n AS b FROM p a JOIN p b ON a.n < b.n), s AS (SELECT a, b, {a} AS x, {b} AS y FROM q),
  r(a, b, x, y, k, line) AS (SELECT a, b, x, y, 0, list_transform(range(0, length(y) + 1), lambda i: 0) FROM s UNION ALL
    SELECT a, b, x, y, k + 1, list_prepend(0, list_transform(range(1, length(y) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: greatest(line[i + 1], line[i] + CASE WHEN substr(y, i, 1) = substr(x, k + 1, 1) THEN 1 ELSE 0 END))))) FROM r WHERE k < length(x)),
  done AS (SELECT a, b, x, y, line[length(y) + 1] AS lcs FROM r WHERE k = length(x))"""
_SORTED = "array_to_string(list_sort(string_split({}, ' ')), ' ')"
_OWN = "trim(array_to_string(list_sort(list_intersect(string_split({0}, ' '), string_split({1}, ' '))), ' ') || ' ' || array_to_string(list_sort(list_distinct(list_filter(string_split({0}, ' '), lambda t: NOT list_contains(string_split({1}, ' '), t)))), ' '))"
SQL = {
    "norm_tokens": f"WITH {v.BIZ_SQL} SELECT p_partkey, trim(regexp_replace(lower(business_name), '[^a-z0-9]+', ' ', 'g')) AS tokens FROM biz",
    "phonetic_skeleton": f"WITH w AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS word FROM part), s AS (SELECT word, translate({_SKELETON}, 'cqwvzg', 'kkbbjj') AS t FROM w), u AS (SELECT word, substr(t, 1, 1) || regexp_replace(substr(t, 2), '[aeiouy]', '', 'g') AS t FROM s) SELECT word, CASE WHEN length(word) < 3 OR NOT regexp_matches(word, '^[a-z]+$') THEN word ELSE {_REPEAT.format(x='t')} END AS skeleton FROM u",
    "domain_extract": "SELECT page_id, CASE WHEN page_id % 5 < 3 THEN 'x' || replace(regexp_extract(url, '^https?://([^/?#.]+)', 1), '-', '') ELSE '' END AS domain FROM pages",
    "alias_parts": f"WITH {v.BIZ_SQL} SELECT p_partkey, CAST([1, 2, 3, 1][p_partkey % 4 + 1] AS INTEGER) AS n_parts, business_name AS first, CASE p_partkey % 4 WHEN 1 THEN country WHEN 2 THEN CAST(p_partkey AS VARCHAR) ELSE business_name END AS last FROM biz",
    "sim_indel_ratio": _LCS.format(a="a", b="b") + " SELECT a, b, round(200.0::DOUBLE * lcs / (length(a) + length(b)), 6) AS ratio FROM done",
    "sim_indel_native": _LCS.format(a="a", b="b") + " SELECT a, b, round(200.0::DOUBLE * lcs / (length(a) + length(b)), 6) AS ratio FROM done",
    "sim_token_sort": _LCS.format(a=_SORTED.format("a"), b=_SORTED.format("b")) + " SELECT a, b, round(200.0::DOUBLE * lcs / (length(x) + length(y)), 6) AS ratio FROM done",
    "sim_token_set": _LCS.format(a=_OWN.format("a", "b"), b=_OWN.format("b", "a"))
    + ", c AS (SELECT *, length(array_to_string(list_intersect(string_split(a, ' '), string_split(b, ' ')), ' ')) AS n FROM done) SELECT a, b, round(CASE WHEN n > 0 AND (n = length(x) OR n = length(y)) THEN 100.0::DOUBLE ELSE greatest(200.0::DOUBLE * lcs / (length(x) + length(y)), CASE WHEN n > 0 THEN greatest(200.0::DOUBLE * n / (n + length(x)), 200.0::DOUBLE * n / (n + length(y))) ELSE 0 END) END, 6) AS ratio FROM c",
    "transliterated": _SPELLED + ", w AS (SELECT key, value, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY key) AS total, row_number() OVER (PARTITION BY key ORDER BY sum(n) DESC, value) AS rn FROM al GROUP BY 1, 2), e AS (SELECT key, value FROM w WHERE rn = 1 AND n >= 2 AND n >= 0.1 * total) SELECT coalesce(e.value, p.key) || ' ' || string_split(business_name, ' ')[2] AS words, coalesce(e.value, p.key) AS component FROM (SELECT *, substr(" + _MAP + ", 1, 2) AS key FROM biz) p LEFT JOIN e ON e.key = p.key",
    "address_cooccurrence": f"WITH {v.BIZ_SQL}, x AS (SELECT CAST(p_partkey % 4 AS INTEGER) AS fold, substr({_MAP}, 1, 1) AS key, unnest(list_distinct([lower(trim(y)) for y in string_split(business_address, ',')])) AS value FROM biz) SELECT fold, key, value, count(*) AS n FROM x GROUP BY 1, 2, 3",
    "indic_predicate": f"WITH {v.BIZ_SQL} SELECT p_partkey % 3 = 0 AS indic, count(*) AS n FROM biz GROUP BY 1",
    "sim_jaro_winkler": _N + " SELECT a, b, round(jaro_winkler_similarity(a, b), 6) AS jw FROM q",
    "hn_relation": """WITH o AS (SELECT o_orderkey, CAST(o_orderkey % 1500 AS VARCHAR) AS a, CAST(o_custkey % 150 AS VARCHAR) AS b FROM orders)
      SELECT o_orderkey, CAST(CASE WHEN a = b THEN 0 WHEN suffix(a, b) OR suffix(b, a) THEN 1 WHEN prefix(a, b) OR prefix(b, a) THEN 2 WHEN length(a) = length(b) AND hamming(a, b) = 1 THEN 3
        WHEN length(a) = length(b) AND list_sort(string_split(a, '')) = list_sort(string_split(b, '')) THEN 4 ELSE 5 END AS INTEGER) AS rel FROM o""",
    "lexicon_alignment": _SPELLED + " SELECT fold, key, value, n FROM al",
    "lexicon_loo": _SPELLED
    + """, f AS (SELECT DISTINCT fold FROM al), r AS (SELECT f.fold, key, value, sum(n) AS n FROM al JOIN f ON al.fold <> f.fold GROUP BY ALL UNION ALL SELECT NULL, key, value, sum(n) FROM al GROUP BY ALL),
      w AS (SELECT *, sum(n) OVER (PARTITION BY fold, key) AS total, row_number() OVER (PARTITION BY fold, key ORDER BY n DESC, value) AS rn FROM r) SELECT fold, key, value FROM w WHERE rn = 1 AND n >= 2 AND n >= 0.1 * total""",
}
