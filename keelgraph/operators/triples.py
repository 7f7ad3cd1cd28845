"""Triples: union, counts and the controlled vocabulary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelgraph.schemas import TRIPLE


def union(*parts: DataFrame) -> DataFrame:
    """All triples of all parts, repeated ones included."""
    return reduce(DataFrame.unionAll, [p.select(*TRIPLE.names) for p in parts])


def counts_by(triples: DataFrame, source: str) -> DataFrame:
    """(source, triples, distinct_triples) of each part, such as a file."""
    return triples.groupBy(source).agg(F.count("*").alias("triples"), F.countDistinct(F.struct("subject", "relation", "object")).alias("distinct_triples"))


def vocabulary_report(triples: DataFrame, vocab: DataFrame) -> DataFrame:
    """(relation, in_vocabulary, triples, subjects) for every relation found, null included."""
    counted = triples.groupBy("relation").agg(F.count("*").alias("triples"), F.countDistinct("subject").alias("subjects"))
    known = vocab.select("relation", F.lit(True).alias("known")).distinct()
    return counted.join(known, "relation", "left").select("relation", F.coalesce("known", F.lit(False)).alias("in_vocabulary"), "triples", "subjects")


def chinese_relations(edges: DataFrame, ordinal: str, relation: str = ":TYPE") -> DataFrame:
    """The edges whose relation has an ideograph, with their 1-based place."""
    return edges.where(F.col(f"`{relation}`").rlike(r"[\x{4E00}-\x{9FFF}]")).withColumn("index", F.col(ordinal) + 1)
