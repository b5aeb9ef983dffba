"""Tables of the data folder and the linkage views derived from them, for Spark and as SQL for the oracle.

``records``: documents dealt to three sources by id, their first six words as a name and the next six as an address, the
language as the country; source 1 is the entity side. ``truth``: exact normalised copies across sources. ``biz``:
business-like names and addresses made of part and nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligatura.functions.columns import split_words
from ligatura.operators.blocking import Index, explode_features


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str = "text"):
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "documents").select("doc_id", "lang", words().alias("n"))
    src = (F.col("doc_id") % 3 + 1).cast("int")
    first = F.split("n", " ", 13)  # twelve words and the rest
    return w.select(
        F.concat(F.lit("S"), src.cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), src.alias("src"),
        F.array_join(F.slice(first, 1, 6), " ").alias("business_name"), F.array_join(F.slice(first, 7, 6), " ").alias("business_address"),
        F.col("lang").alias("country"), F.md5("n").alias("h"),
    )


def truth(rec: DataFrame) -> DataFrame:
    s = rec.where("src = 1").select("country", "h", F.col("entity_id").alias("s"))
    return rec.where("src <> 1").select("country", "h", F.col("entity_id").alias("t")).join(s, ["country", "h"]).groupBy("t").agg(F.min("s").alias("s"))


def with_features(rec: DataFrame) -> DataFrame:
    """The light blocking features of ``records``: name words, address words, and pairs of the two."""
    name, addr = split_words("business_name"), split_words("business_address")
    tag = lambda t: lambda x: F.concat(F.lit(t), x)
    cross = F.flatten(F.transform(F.slice(name, 1, 3), lambda x: F.transform(F.slice(addr, 1, 5), lambda y: F.concat(F.lit("c:"), x, F.lit("_"), y))))
    return rec.withColumns({"feat_name": F.transform(name, tag("n:")), "feat_addr": F.transform(addr, tag("a:")), "feat_cross": cross})


def sides(rec: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entity features, query features, entities)."""
    f = explode_features(with_features(rec).select("entity_id", "country", "src", "feat_name", "feat_addr", "feat_cross"))
    entities = rec.where("src = 1")
    return f.where("id like 'S1-%'"), f.where("id not like 'S1-%'"), entities


def index(spark: SparkSession, sf_dir: str) -> Index:
    return Index(*sides(records(spark, sf_dir)))


def candidates(spark: SparkSession, sf_dir: str, k: int = 3) -> DataFrame:
    return index(spark, sf_dir).retrieve(k)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t, s, p): candidates with p from the score."""
    return candidates(spark, sf_dir).select("t", "s", F.round(F.least(F.col("score") / 3, F.lit(1.0)), 6).alias("p"))


def biz(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    ends = F.array(*map(F.lit, ("Inc", "LLC", "Pvt Ltd", "& Co", "Technologies")))
    j = part.join(F.broadcast(nation), part["p_size"] % 25 == nation["n_nationkey"])  # nation: 25 rows by definition
    return j.select(
        "p_partkey", F.concat_ws(" ", "p_name", F.element_at(ends, (F.col("p_partkey") % 5 + 1).cast("int"))).alias("business_name"),
        F.concat((F.col("p_partkey") % 97 + 1).cast("string"), F.lit(" "), F.col("p_brand"), F.lit(" Street, "), F.col("n_name")).alias("business_address"), F.col("n_name").alias("country"),
    )


RECORDS_SQL = """
base AS (SELECT doc_id, lang, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS n FROM documents),
records AS (
  SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id, CAST(1 + doc_id % 3 AS INTEGER) AS src,
    array_to_string(string_split(n, ' ')[1:6], ' ') AS business_name, array_to_string(string_split(n, ' ')[7:12], ' ') AS business_address,
    lang AS country, md5(n) AS h FROM base),
truth AS (
  SELECT a.entity_id AS t, min(b.entity_id) AS s FROM records a JOIN records b ON a.country = b.country AND a.h = b.h
  WHERE a.src <> 1 AND b.src = 1 GROUP BY 1)"""

FEATURES_SQL = (
    RECORDS_SQL
    + """,
words AS (
  SELECT entity_id AS id, country, src, list_filter(string_split(business_name, ' '), lambda x: x <> '') AS nw,
    list_filter(string_split(business_address, ' '), lambda x: x <> '') AS aw FROM records),
feats AS (
  SELECT DISTINCT * FROM (
    SELECT id, country, src, 'name' AS block, 'n:' || unnest(nw) AS feature FROM words
    UNION ALL SELECT id, country, src, 'addr', 'a:' || unnest(aw) FROM words
    UNION ALL SELECT id, country, src, 'cross', 'c:' || x || '_' || y FROM (SELECT id, country, src, unnest(nw[1:3]) AS x, aw FROM words), unnest(aw[1:5]) AS u(y))),
n_s AS (SELECT country, count(*) AS n_s FROM records WHERE src = 1 GROUP BY 1),
dfs AS (SELECT country, block, feature, count(*) AS df FROM feats WHERE src = 1 GROUP BY ALL),
idf AS (SELECT dfs.*, ln(1 + n_s / df) AS idf FROM dfs JOIN n_s USING (country)),
weights AS (
  SELECT id, f.country, f.src, f.block, f.feature, coalesce(df, 0) AS df, coalesce(idf, ln(1 + n_s)) AS idf
  FROM feats f LEFT JOIN idf USING (country, block, feature) JOIN n_s ON n_s.country = f.country),
normed AS (SELECT *, idf / sqrt(sum(idf * idf) OVER (PARTITION BY id, block)) AS w FROM weights)"""
)

CANDIDATES_SQL = (
    FEATURES_SQL
    + """,
scores AS (
  SELECT t.id AS t, s.id AS s, sum(t.w * s.w) AS score FROM normed t JOIN normed s USING (country, block, feature)
  WHERE t.src <> 1 AND s.src = 1 AND s.df <= 1000 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY round(score, 9) DESC, s) - 1 AS rank FROM scores WHERE round(score, 9) >= 0.1),
candidates AS (SELECT * FROM ranked WHERE rank < 3),
pairs AS (SELECT t, s, round(least(score / 3, 1.0), 6) AS p FROM candidates)"""
)

LINKS_SQL = (
    CANDIDATES_SQL
    + """,
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY p DESC, s) AS rn FROM pairs) WHERE rn = 1),
links AS (
  SELECT best.t, best.s, best.p, coalesce(truth.s = best.s, false) AS tp, truth.s IS NULL AS decoy FROM best LEFT JOIN truth ON truth.t = best.t),
entities AS (
  SELECT r.entity_id AS s, r.country, coalesce(n, 0) AS nt FROM records r LEFT JOIN (SELECT s, count(*) AS n FROM truth GROUP BY 1) x ON x.s = r.entity_id WHERE r.src = 1)"""
)

BIZ_SQL = """
biz AS (
  SELECT p_partkey, p_name || ' ' || ['Inc', 'LLC', 'Pvt Ltd', '& Co', 'Technologies'][p_partkey % 5 + 1] AS business_name,
    (p_partkey % 97 + 1) || ' ' || p_brand || ' Street, ' || n_name AS business_address, n_name AS country
  FROM part JOIN nation ON p_size % 25 = n_nationkey)"""


def score_sql(threshold: str, weight: str = "1.0") -> str:
    """SQL of (s, nt, tp, npred, f) of every entity at a threshold."""
    return f"""
sums AS (SELECT s, sum(CAST(tp AS DOUBLE)) AS tp, sum(CASE WHEN tp THEN 1.0 WHEN decoy THEN {weight} ELSE 1.0 END) AS np FROM links WHERE p >= {threshold} GROUP BY s),
joined AS (SELECT e.*, coalesce(x.tp, 0) AS tp, CAST(coalesce(np, 0) AS DOUBLE) AS npred FROM entities e LEFT JOIN sums x USING (s)),
pr AS (SELECT *, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS pre, CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS rec FROM joined),
scored AS (SELECT *, CASE WHEN nt = 0 AND npred = 0 THEN 1.0 WHEN nt = 0 THEN 0.0 WHEN pre + rec > 0 THEN 1.25 * pre * rec / (0.25 * pre + rec) ELSE 0.0 END AS f FROM pr)"""
