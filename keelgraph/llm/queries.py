"""Queries of the operators for training data, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelgraph.llm.abuse import THRESHOLD, score_documents, source_rates
from keelgraph.llm.duplicates import duplicate_pairs, rooted_records, survivors
from keelgraph.llm.encoding import encode
from keelgraph.llm.mixing import mix, mix_report, plan, sized
from keelgraph.llm.pieces import split_oversized
from keelgraph.llm.relations import map_relations, relation_report
from keelgraph.llm.spellings import consistent_forms, same_looking
from keelgraph.session import table


def _names(spark: SparkSession, folder: str) -> DataFrame:
    entities, triples = table(spark, folder, "entities"), table(spark, folder, "triples")
    return reduce(DataFrame.unionAll, [entities.select(F.col("entity_name").alias("name")), triples.select("subject"), triples.select("object")])


def _rooted(spark: SparkSession, folder: str) -> DataFrame:
    return rooted_records(table(spark, folder, "entities"), "entity_id", "entity_name")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    rooted = _rooted(spark, folder)
    return duplicate_pairs(rooted, survivors(rooted, least=2))


def p2_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return survivors(_rooted(spark, folder)).drop("root")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_looking(_names(spark, folder), "name")


def p3_forms(spark: SparkSession, folder: str) -> DataFrame:
    return consistent_forms(_names(spark, folder), "name")


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents"), "doc_id", "text")


def p4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split_oversized(table(spark, folder, "chunks"), "metadata", "chunk_content")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_pieces(spark, folder).where("piece = 0 AND pieces > 1").select("metadata")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return map_relations(table(spark, folder, "triples"), table(spark, folder, "relation_vocab"))


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    return relation_report(table(spark, folder, "triples"), table(spark, folder, "relation_vocab"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    sizes = sized(table(spark, folder, "documents"))
    return mix(sizes, plan(sizes, table(spark, folder, "mix_targets")))


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    sizes, targets = sized(table(spark, folder, "documents")), table(spark, folder, "mix_targets")
    return mix_report(sizes, plan(sizes, targets), targets)


def p8_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_scores(spark, folder).where(F.col("score") >= THRESHOLD).select("doc_id")


def p8_rates(spark: SparkSession, folder: str) -> DataFrame:
    return source_rates(p8_scores(spark, folder))


QUERIES = {
    "p2_found": p2_found,
    "p2_survivors": p2_survivors,
    "p3_found": p3_found,
    "p3_forms": p3_forms,
    "p4_found": p4_found,
    "p4_pieces": p4_pieces,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p6_ids": p6_ids,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_scores": p8_scores,
    "p8_rates": p8_rates,
}
ORACLE: dict[str, str] = {
    "p4_found": "SELECT metadata FROM chunks WHERE length(chunk_content) > 512",
}
