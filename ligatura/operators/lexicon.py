"""Learned lexicons for words of another script, with leave-one-fold-out versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ligatura.functions import textnorm as tn
from ligatura.functions.columns import split_words
from ligatura.operators.relational import leave_one_fold_out, most_common

MIN_COUNT, MIN_SHARE = 2, 0.5


def name_alignments(pairs: DataFrame) -> DataFrame:
    """(fold, key, value, n): words of equal position in names of equal length (t_name, s_name, fold)."""
    t, s = split_words("t_name", r"\s+"), split_words("s_name", r"\s+")
    both = pairs.select("fold", t.alias("t"), s.alias("s")).where("size(t) = size(s)")
    one = both.select("fold", F.explode(F.arrays_zip("t", "s")).alias("z")).select("fold", F.col("z.t").alias("word"), tn.latin_tokens(tn.to_ascii("z.s")).alias("latin"))
    kept = one.where(F.col("word").rlike(tn.INDIC) & (F.size("latin") == 1)).select("fold", tn.indic_key("word").alias("key"), F.col("latin")[0].alias("value"))
    return kept.groupBy("fold", "key", "value").agg(F.count("*").alias("n"))


def address_cooccurrences(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts (fold, key, value, n) of Indic components with an entity's components, and (fold, key, n) of the components."""
    parts = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")
    t = pairs.select("fold", F.explode(parts("t_addr")).alias("comp"), F.array_distinct(F.transform(parts("s_addr"), F.lower)).alias("values"))
    t = t.where(F.col("comp").rlike(tn.INDIC)).select("fold", tn.indic_key("comp").alias("key"), "values")
    met = t.select("fold", "key", F.explode("values").alias("value")).groupBy("fold", "key", "value").agg(F.count("*").alias("n"))
    return met, t.groupBy("fold", "key").agg(F.count("*").alias("n"))


def select_entries(counts: DataFrame, least: int = MIN_COUNT, share: float = MIN_SHARE) -> DataFrame:
    """(fold, key, value): the most common value of each key with enough count and share."""
    return most_common(counts, ["fold", "key"], "value", least, share).select("fold", "key", "value")


def fold_lexicons(counts: DataFrame, folds: DataFrame, least: int = MIN_COUNT, share: float = MIN_SHARE) -> DataFrame:
    """(fold, key, value) with fold k learned from all folds but k, and null from all."""
    rest = leave_one_fold_out(counts, folds, ["key", "value"])
    return select_entries(rest.withColumn("fold", F.coalesce("fold", F.lit(-2))), least, share).withColumn("fold", F.when(F.col("fold") != -2, F.col("fold")))


def as_map(entries: DataFrame, fold: int | None, most: int = 200_000):
    """A fold's entries as a map column literal; lexicons are word lists, and larger ones are refused rather than shipped."""
    rows = entries.where(F.col("fold") == fold if fold is not None else F.col("fold").isNull()).select("key", "value").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a lexicon of more than {most} entries: join it instead")
    return F.create_map(*(F.lit(x) for r in sorted(rows) for x in r)) if rows else F.expr("cast(map() as map<string,string>)")
