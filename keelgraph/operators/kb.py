"""The entity knowledge base: merging mentions and records, lookups and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelgraph.functions.text import fold_summaries, ordered

LISTS = ("type", "domain_relevance", "chunk_ids")


def _element(kind: str, place: Column, text: Column | None = None, number: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), place.cast("int").alias("place"), (F.lit(None) if text is None else text).cast("string").alias("text"),
                    (F.lit(None) if number is None else number).cast("long").alias("number"))


def _united(rows: DataFrame, keys: list[str], elements: Column) -> DataFrame:
    """(keys, type, domain_relevance, chunk_ids): the distinct elements of a group in order of first appearance.

    Elements are reduced to their first place by partial aggregation before they are gathered, so that a group of a third of
    all rows gathers no more than its distinct values.
    """
    listed = rows.select(*keys, "at", F.explode(elements).alias("e")).select(*keys, "at", "e.*").where("text IS NOT NULL OR number IS NOT NULL")
    first = listed.groupBy(*keys, "kind", "text", "number").agg(F.min(F.struct("at", "place")).alias("first"))
    values = lambda kind, value: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("first", F.col(value).alias("value"))))), lambda x: x["value"])
    return first.groupBy(*keys).agg(values("type", "text").alias("type"), values("domain_relevance", "text").alias("domain_relevance"), values("chunk_ids", "number").alias("chunk_ids"))


def _merged(rows: DataFrame, keys: list[str], elements: Column) -> DataFrame:
    summaries = rows.groupBy(*keys).agg(fold_summaries(ordered([F.col("at")], F.coalesce("summary", F.lit("")))).alias("summary"))
    united = _united(rows, keys, elements)
    for key in keys:
        united = united.withColumnRenamed(key, f"_{key}")
    same = F.lit(True)
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    texts, numbers = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    return summaries.join(united, same, "left").select(
        *keys, F.coalesce("type", texts).alias("type"), F.coalesce("domain_relevance", texts).alias("domain_relevance"), "summary", F.coalesce("chunk_ids", numbers).alias("chunk_ids"))


def build(mentions: DataFrame, order: list[str], within: list[str] | None = None) -> DataFrame:
    """Mentions (entity_name, type, domain_relevance, summary, chunk_id) merged by name, in the given order.

    Lists hold the distinct values in order of first appearance; summaries are folded in order. `within` are columns, such as
    a range of chunks, that are merged apart: the fold depends on them, so ranges are merged by `merge` afterwards. Names are
    compared exactly; null names are left out; null values stay out of the lists, null summaries are empty ones. A name's
    row holds all its different summaries after each other, by the meaning of the fold, so its size follows the name's.
    """
    rows = mentions.where("entity_name IS NOT NULL").withColumn("at", F.struct(*order))
    zero = F.lit(0)
    elements = F.array(_element("type", zero, F.col("type")), _element("domain_relevance", zero, F.col("domain_relevance")), _element("chunk_ids", zero, number=F.col("chunk_id")))
    return _merged(rows, [*(within or []), "entity_name"], elements)


def merge(records: DataFrame, order: list[str]) -> DataFrame:
    """Knowledge base records merged by name, in the given order (such as file and position).

    Lists are united in order of first appearance, summaries folded. A null list counts as empty, nulls in lists are left out.
    """
    rows = records.where("entity_name IS NOT NULL").withColumn("at", F.struct(*order))
    listed = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x, i: _element(c, i, x))
    texts = [listed(c) for c in LISTS[:2]]
    numbers = F.transform(F.coalesce("chunk_ids", F.array().cast("array<bigint>")), lambda x, i: _element("chunk_ids", i, number=x))
    return _merged(rows, ["entity_name"], F.concat(*texts, numbers))


def load(records: DataFrame, order: str) -> DataFrame:
    """One record per name: the place of the first, the values of the last, as a dictionary keeps them."""
    values = F.struct(*[c for c in records.columns if c not in ("entity_name", order)])
    return records.groupBy("entity_name").agg(F.min(order).alias(order), F.max_by(values, order).alias("v")).select("entity_name", order, "v.*")


def lookup(kb: DataFrame, name: str) -> DataFrame:
    """The record of exactly that name; no row where there is none."""
    return kb.where(F.col("entity_name") == name)


def statistics(kb: DataFrame) -> DataFrame:
    """One row (entities, chunk_references) of a knowledge base, that is one record a name: records, and the sizes of their chunk lists together."""
    return kb.agg(F.count("*").alias("entities"), F.coalesce(F.sum(F.when(F.col("chunk_ids").isNotNull(), F.size("chunk_ids"))), F.lit(0)).alias("chunk_references"))


def type_histogram(kb: DataFrame) -> DataFrame:
    """(type, entities): how many records of a knowledge base name each type; a type repeated in a record counts as often."""
    return kb.select(F.explode("type").alias("type")).groupBy("type").agg(F.count("*").alias("entities"))


def range_of(ordinal: Column, size: int, start: int = 0) -> Column:
    """The 0-based range of `size` chunks that a chunk ordinal falls into."""
    return F.floor((ordinal - start) / size)
