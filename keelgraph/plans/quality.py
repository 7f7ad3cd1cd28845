"""Queries on the quality of the knowledge graph's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelgraph.operators.orphans import orphan_references, orphan_report
from keelgraph.session import table

ENDPOINTS = ["subject", "object"]


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_references(table(spark, folder, "triples"), table(spark, folder, "entities"), "triple_id", ENDPOINTS, "entity_name")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder).select("triple_id", "endpoint", "reason")


def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_report(_orphans(spark, folder), table(spark, folder, "triples"), "triples", ENDPOINTS)


QUERIES = {"p1_found": p1_found, "p1_report": p1_report}
ORACLE: dict[str, str] = {}
