"""Every registered query of the engine, by name, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ligatura.plans import decision_queries, relational_queries, retrieval_queries, text_queries

GROUPS = (relational_queries, retrieval_queries, text_queries, decision_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for group in GROUPS for name, f in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for group in GROUPS for name, sql in group.SQL.items()}
