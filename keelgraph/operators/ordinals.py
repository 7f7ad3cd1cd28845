"""Ordinals that need no single task: every task numbers its own part, offsets come from the parts' sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelgraph.session import durable

#: Bits of monotonically_increasing_id that count the rows of one partition.
ROW_BITS = 33


def ordinal(df: DataFrame, order: list[str], name: str = "ordinal", parts: int | None = None) -> DataFrame:
    """df with the 0-based place of each row in the whole table by `order`, ties in any order.

    One shuffle: rows are range partitioned, sorted and numbered where they are. The numbered rows are kept, since another
    run might cut the ranges elsewhere; only the parts' sizes, one row a part, are joined to them. An empty table stays so.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    own = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(offsets, part == F.col("_part")).withColumn(name, own + F.col("_offset")).drop("_id", "_part", "_offset")
