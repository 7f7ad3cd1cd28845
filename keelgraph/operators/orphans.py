"""References to records that do not exist, are deleted or come later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelgraph.functions.bloom import bloom_filter
from keelgraph.functions.lookalike import look_key
from keelgraph.session import durable


def orphan_references(children: DataFrame, parents: DataFrame, child_id: str, fields: list[str], parent_name: str) -> DataFrame:
    """One row (child_id, endpoint, name, reason, month) per reference of which no parent record stands.

    A parent matches a reference when both names look the same. It stands for a child when it was loaded no later and
    not deleted by then (parents.loaded_at, parents.deleted_at, children.loaded_at). Reasons: `missing`, nothing matches;
    `late`, a match is loaded after the child; else `deleted`. `month` is the month of the child's load.

    A broadcast Bloom filter of the parents' names proves references missing; these go to the result as they are, and only
    what passes the filter is joined. Of each name the join carries five times, from which nearly every reference is decided;
    the others, between the first and the last end of a deleted record, are held against those records month by month. So
    no name's records are ever gathered, and a name of a third of all references has one row on the other side of the join.

    Null and empty references are no cases; null and empty parent names match nothing. A child with a null loaded_at has
    no standing record: `missing` or `deleted`. A parent with a null loaded_at never stands. Repeated rows are reported
    each. Other columns of either table are not read.
    """
    named = parents.select(F.col(parent_name).alias("name"), "loaded_at", "deleted_at").where("name <> ''")
    records = durable(named.select(look_key("name").alias("key"), "loaded_at", "deleted_at"))
    closed = "loaded_at < deleted_at"
    known = records.groupBy("key").agg(
        F.max("loaded_at").alias("last_loaded"),
        F.min(F.expr("CASE WHEN deleted_at IS NULL THEN loaded_at END")).alias("open_from"),
        F.min(F.expr(f"CASE WHEN {closed} THEN loaded_at END")).alias("first_start"),
        F.max(F.expr(f"CASE WHEN {closed} THEN deleted_at END")).alias("last_end"),
        F.lit(True).alias("known"),
    )
    references = (
        children.select(F.col(child_id).alias("id"), F.col("loaded_at").alias("at"),
                        F.explode(F.array(*[F.struct(F.lit(f).alias("endpoint"), F.col(f).alias("name")) for f in fields])).alias("r"))
        .select("id", "at", "r.*").where("name <> ''")
        # generated, so that a filter on the key isn't moved before it with a second evaluation of the key
        .select("*", F.explode(F.array(look_key("name"))).alias("key"))
    )
    passes = bloom_filter(known, "key")
    refused, asked = references.where(~passes(F.col("key"))), references.where(passes(F.col("key")))
    joined = asked.join(known, "key", "left").where("open_from IS NULL OR at IS NULL OR at < open_from")
    between = F.expr("known AND at >= first_start AND at < last_end")
    # One pass over the join: a row that must be held against the deleted records carries its month, any other none.
    judged = joined.withColumn("slot", F.when(between, _month("at")))
    spans = (
        records.where(closed).groupBy("key", F.col("loaded_at").alias("start")).agg(F.max("deleted_at").alias("end"))
        .withColumn("slot", F.explode(F.sequence(_month("start"), _month("end"))))
    )
    alone = F.expr("CASE WHEN slot IS NULL THEN concat('\\u0000', id, endpoint) ELSE key END")
    left = judged.withColumn("span_key", alone).withColumn("slot", F.coalesce("slot", F.lit(0)))
    right = spans.select(F.col("key").alias("k"), F.col("slot").alias("s"), "start", "end")
    standing = (left.span_key == right.k) & (left.slot == right.s) & (left["at"] >= right.start) & (left["at"] < right.end)
    reason = F.expr("CASE WHEN known IS NULL THEN 'missing' WHEN last_loaded > at THEN 'late' ELSE 'deleted' END")
    result = lambda rows, why: rows.select(F.col("id").alias(child_id), "endpoint", "name", why.alias("reason"), F.date_format("at", "yyyy-MM").alias("month"))
    return result(refused, F.lit("missing")).unionAll(result(left.join(right, standing, "left_anti"), reason))


def _month(column: str):
    return F.year(column) * 12 + F.month(column)


def orphan_report(orphans: DataFrame, children: DataFrame, child_table: str, fields: list[str]) -> DataFrame:
    """Orphans and references by table, field, month of load and reason: `n` cases among `refs` non-empty references.

    Months without a case are listed with reason null and n 0.
    """
    refs = (
        children.select(F.date_format("loaded_at", "yyyy-MM").alias("month"),
                        *[F.when(F.col(f) != "", 1).otherwise(0).alias(f"n_{f}") for f in fields])
        .groupBy("month").agg(*[F.sum(f"n_{f}").alias(f) for f in fields])
        .select("month", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("refs")) for f in fields])).alias("r"))
        .select("month", "r.*")
    )
    cases = orphans.groupBy(F.col("month").alias("m"), F.col("endpoint").alias("f"), "reason").agg(F.count("*").alias("n"))
    return refs.join(cases, F.col("month").eqNullSafe(F.col("m")) & (F.col("field") == F.col("f")), "left").select(
        F.lit(child_table).alias("table"), "field", "month", "reason", F.coalesce("n", F.lit(0)).alias("n"), "refs")
