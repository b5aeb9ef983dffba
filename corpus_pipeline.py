"""Corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, PII redaction, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes every stage's result as
Parquet to the shared folder and reads it back as the next one's input. All stages but the last keep the columns of
``documents``, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ligatura.llm import near_duplicates, pii_tagger, quality_rules, retrieval_packing, template_decontamination
from ligatura.llm.common import table, written


def stage_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the boosted trees reject go."""
    return quality_rules.filter_documents(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: shingles of five words, a similarity of 0.8 or more."""
    return near_duplicates.deduplicate(docs, k=5, percent=80)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, also re-parameterised ones, go."""
    return template_decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by placeholders."""
    return pii_tagger.redact(docs, pii_tagger.fit(docs))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of windows of 4,096 tokens."""
    return retrieval_packing.pack(docs)


STAGES = [
    ("quality_rules", stage_quality_rules),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("pii", stage_pii),
    ("packing", stage_packing),
]

#: Trained models, a randomised join and a tokenizer decide: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
