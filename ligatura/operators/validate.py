"""Validation of id-list files before they are handed in: one row a finding, nothing if all is well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def findings(lists: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(check, id) of an id-list table (s, ids comma-joined) against the required entities (s) and the known ids (t).

    duplicate_row, repeated_id, self_match, wrong_prefix, unknown_id (with ``known``), missing_entity, extra_entity.
    """
    rows = lists.select("s", F.filter(F.split(F.coalesce("ids", F.lit("")), ","), lambda x: x != "").alias("m"))
    named = lambda df, check, column: df.select(F.lit(check).alias("check"), F.col(column).alias("id")).distinct()
    each = rows.select("s", F.explode("m").alias("t"))
    out = [
        named(rows.groupBy("s").agg(F.count("*").alias("n")).where("n > 1"), "duplicate_row", "s"),
        named(rows.where(F.size("m") != F.size(F.array_distinct("m"))), "repeated_id", "s"),
        named(each.where(F.col("t").startswith("S1-")), "self_match", "t"),
        named(each.where(~F.col("t").rlike("^S[123]-")), "wrong_prefix", "t"),
        named(required.select("s").join(rows, "s", "left_anti"), "missing_entity", "s"),
        named(rows.join(required.select("s"), "s", "left_anti"), "extra_entity", "s"),
    ]
    if known is not None:
        out.append(named(each.where(F.col("t").rlike("^S[23]-")).join(known.select("t"), "t", "left_anti"), "unknown_id", "t"))
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def format_findings(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """(check, id) of the file itself: empty_file, not_tab_separated, wrong_header (its first line), wrong_field_count (a line)."""
    lines = spark.read.text(path)
    first = lines.limit(1).collect()  # one line
    if not first:
        return spark.createDataFrame([("empty_file", path)], "check string, id string")
    header = first[0]["value"]
    if "\t" not in header and "," in header:
        return spark.createDataFrame([("not_tab_separated", header)], "check string, id string")
    if [c.strip().lower() for c in header.split("\t")] != list(columns):
        return spark.createDataFrame([("wrong_header", header)], "check string, id string")
    odd = lines.where(F.size(F.split("value", "\t")) != len(columns)).where(F.trim("value") != "")
    return odd.select(F.lit("wrong_field_count").alias("check"), F.col("value").alias("id")).distinct()


def outside_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s) of entities with matched ids that aren't among their candidates: a warning, not an error."""
    ids = lambda df: df.select("s", F.explode(F.split("ids", ",")).alias("t")).where("t != ''")
    return ids(matched).join(ids(candidates), ["s", "t"], "left_anti").select("s").distinct()
