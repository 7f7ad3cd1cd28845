"""Incremental runs with Structured Streaming: each chunk is worked on once, each batch written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelgraph.operators import kb
from keelgraph.schemas import TRIPLE


def stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100, file_format: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(path)


def run_available(rows: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hands every micro-batch of what is there to `each`, then ends; the next run goes on where this one stopped."""
    query = rows.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_batches(rows: DataFrame, checkpoint: str, target: str, prepared: Callable[[DataFrame], DataFrame], mode: str = "append") -> StreamingQuery:
    """Every batch, prepared, in a partition of its own; a batch that is repeated after a failure overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (prepared(batch).withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target))

    return run_available(rows, checkpoint, write, mode)


def append_triples(rows: DataFrame, checkpoint: str, target: str) -> StreamingQuery:
    return append_batches(rows, checkpoint, target, lambda batch: batch.select(*TRIPLE.names))


def merge_knowledge(rows: DataFrame, checkpoint: str, target: str) -> StreamingQuery:
    """Records merged by name within each batch and added to the batches before; `knowledge` merges the batches.

    A batch writes only the names it has, so its cost follows its own size and not that of the knowledge base.
    """
    records = lambda batch: kb.merge(batch.select("entity_name", *kb.LISTS, "summary", "position"), ["position"])
    return append_batches(rows, checkpoint, target, records)


def knowledge(spark: SparkSession, target: str) -> DataFrame:
    """The knowledge base that batches make together: a name's records merged in the order of their batches, which is what
    merging batch after batch gives.
    """
    return kb.merge(spark.read.parquet(target), ["batch"])


def windowed_counts(rows: DataFrame, time: str = "loaded_at", late: str = "30 days", length: str = "1 day") -> DataFrame:
    """(window, relation, triples) per period of load.

    Counts are held as state until the watermark, `late` behind the latest time seen, has passed their period; rows that come
    later still are left out. So the state is as large as the periods within `late`.
    """
    return rows.withWatermark(time, late).groupBy(F.window(time, length), "relation").agg(F.count("*").alias("triples"))


def counted(rows: DataFrame, checkpoint: str, target: str) -> StreamingQuery:
    """The counts that each batch of an aggregated stream changes, in a partition of the batch's own; see `latest`."""
    return append_batches(rows, checkpoint, target, lambda batch: batch, "update")


def latest(spark: SparkSession, target: str) -> DataFrame:
    """(window, relation, triples) as the last batch that changed each count left it."""
    rows = spark.read.parquet(target)
    return rows.groupBy("window", "relation").agg(F.max_by("triples", "batch").alias("triples"))
