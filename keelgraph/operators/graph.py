"""The graph: enrichment of entities from triples, node and edge tables, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelgraph.functions.text import NO_CHUNK, NO_RELEVANCE, NO_SUMMARY, NO_TYPE, clean_label, joined
from keelgraph.operators.ordinals import ordinal


def enrich(kb: DataFrame, triples: DataFrame, kb_order: str, triple_order: str) -> DataFrame:
    """Records of the knowledge base and of every triple's endpoint that has none, with the chunks of their relations.

    (entity_name, type, domain_relevance, summary, entity_chunk_id, relation_chunk_id, src, ord): known names first, in
    `kb_order`, then new ones in order of first appearance, subject before object; (src, ord) is that order. A new name gets
    placeholders. relation_chunk_id has the distinct chunks in order of appearance, `unknown` for a triple without one. Null
    endpoints are left out. Chunks are reduced to their first appearance per name before they are gathered, so that a name
    holding a third of the triples gathers no more than the chunks it is in.
    """
    endpoints = triples.select(F.col(triple_order).alias("t"), F.coalesce("chunk_id", F.lit(NO_CHUNK)).alias("chunk"),
                               F.posexplode(F.array("subject", "object")).alias("side", "name")).where("name IS NOT NULL")
    first = endpoints.groupBy("name", "chunk").agg(F.min(F.struct("t", "side")).alias("at"))
    seen = first.groupBy("name").agg(F.min("at").alias("ep_ord"),
                                     F.transform(F.array_sort(F.collect_list(F.struct("at", "chunk"))), lambda x: x["chunk"]).alias("relation_chunk_id"))
    known = kb.select("entity_name", "type", "domain_relevance", "summary", F.col("chunk_ids").alias("entity_chunk_id"), F.col(kb_order).cast("long").alias("kb_ord"))
    both = known.join(seen, known.entity_name == seen.name, "full")
    new = F.col("entity_name").isNull()
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    return both.select(
        F.coalesce("entity_name", "name").alias("entity_name"),
        F.when(new, F.array(F.lit(NO_TYPE))).otherwise(F.coalesce("type", empty("string"))).alias("type"),
        F.when(new, F.array(F.lit(NO_RELEVANCE))).otherwise(F.coalesce("domain_relevance", empty("string"))).alias("domain_relevance"),
        F.when(new, NO_SUMMARY).otherwise(F.coalesce("summary", F.lit(""))).alias("summary"),
        F.coalesce("entity_chunk_id", empty("bigint")).alias("entity_chunk_id"),
        F.coalesce("relation_chunk_id", empty("string")).alias("relation_chunk_id"),
        new.cast("int").alias("src"),
        F.struct(F.coalesce("kb_ord", "ep_ord.t").alias("a"), F.when(new, F.col("ep_ord.side")).otherwise(0).alias("b")).alias("ord"),
    )


def nodes(enriched: DataFrame) -> DataFrame:
    """Node rows for the graph import, numbered `entity_1`, `entity_2`... in the order of the enrichment."""
    numbered = ordinal(enriched.select("*", F.col("ord.a").alias("_a"), F.col("ord.b").alias("_b")), ["src", "_a", "_b"], "n")
    label = joined(F.col("type"))
    return numbered.select(
        F.concat(F.lit("entity_"), (F.col("n") + 1).cast("string")).alias("id:ID"),
        F.col("entity_name").alias("name"), "summary", joined(F.col("type")).alias("type"), joined(F.col("domain_relevance")).alias("domain_relevance"),
        joined(F.col("entity_chunk_id"), NO_CHUNK).alias("entity_chunk_id"), joined(F.col("relation_chunk_id"), NO_CHUNK).alias("relation_chunk_id"),
        F.concat(F.lit("Entity;"), label).alias(":LABEL"),
    )


def edges(triples: DataFrame, node_rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Edge rows: the ids of both ends and the relation; triples with an end that is no node are left out."""
    ids = node_rows.select(F.col("name"), F.col("id:ID").alias("id"))
    starts, ends = ids.toDF("subject", ":START_ID"), ids.toDF("object", ":END_ID")
    return triples.join(starts, "subject").join(ends, "object").select(*(keep or []), ":START_ID", ":END_ID", F.col("relation").alias(":TYPE"))


def clean_labels(node_rows: DataFrame) -> DataFrame:
    return node_rows.withColumn(":LABEL", clean_label(F.col("`:LABEL`")))


def label_distribution(node_rows: DataFrame) -> DataFrame:
    """(label, nodes), the commonest first."""
    return node_rows.groupBy(F.col("`:LABEL`").alias("label")).agg(F.count("*").alias("nodes")).orderBy(F.desc("nodes"), "label")


def properties(node_rows: DataFrame) -> DataFrame:
    """(id, labels, props): the form of a node in the graph; props has what is not null, without id and label."""
    names = [c for c in node_rows.columns if c not in ("id:ID", ":LABEL")]
    pairs = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(f"`{c}`") for c in names]))
    labels = F.filter(F.transform(F.split("`:LABEL`", ";"), lambda x: F.trim(x)), lambda x: x != "")
    return node_rows.select(F.col("id:ID").alias("id"), F.coalesce(labels, F.array().cast("array<string>")).alias("labels"),
                            F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("props"))


def upsert_nodes(existing: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """(id, labels, props): incoming nodes merged into the existing ones by id.

    Incoming properties overwrite, others stay; labels are united, existing first. Of several incoming rows with one id
    all labels count, and of each property the last value. Rows with a null id are left out.
    """
    parts = incoming.where("id IS NOT NULL").select("id", F.col(order).alias("o"), "labels", "props")
    values = parts.select("id", "o", F.explode("props").alias("k", "v")).groupBy("id", "k").agg(F.max_by("v", "o").alias("v"))
    values = values.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("new_props"))
    labels = parts.groupBy("id").agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("o", "labels"))), lambda x: x["labels"]))).alias("new_labels"))
    changes = labels.join(values, "id", "left")
    none_s, none_m = F.array().cast("array<string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    old, new = F.coalesce("props", none_m), F.coalesce("new_props", none_m)
    return existing.join(changes, "id", "full").select(
        "id", F.array_union(F.coalesce("labels", none_s), F.coalesce("new_labels", none_s)).alias("labels"),
        F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new).alias("props"))


def upsert_edges(existing: DataFrame, incoming: DataFrame, node_ids: DataFrame) -> DataFrame:
    """(start, end, type): existing edges and those incoming ones whose ends are nodes, each once. A null type is one type."""
    ids = node_ids.select("id").distinct()
    valid = incoming.join(ids.toDF("start"), "start", "left_semi").join(ids.toDF("end"), "end", "left_semi")
    return existing.select("start", "end", "type").unionAll(valid.select("start", "end", "type")).distinct()


def import_counts(incoming_nodes: DataFrame, incoming_edges: DataFrame, node_ids: DataFrame) -> DataFrame:
    """One row (entities_imported, relations_imported): input rows that were matched, as the import reports them."""
    ids = node_ids.select("id").distinct()
    valid = incoming_edges.join(ids.toDF("start"), "start", "left_semi").join(ids.toDF("end"), "end", "left_semi")
    counted = incoming_nodes.where("id IS NOT NULL").select(F.lit(1).alias("e"), F.lit(0).alias("r")).unionAll(valid.select(F.lit(0), F.lit(1)))
    return counted.agg(F.coalesce(F.sum("e"), F.lit(0)).alias("entities_imported"), F.coalesce(F.sum("r"), F.lit(0)).alias("relations_imported"))


def importable(node_rows: DataFrame) -> DataFrame:
    """The rows to import: none where the label column is missing."""
    return node_rows if ":LABEL" in node_rows.columns else node_rows.limit(0)
