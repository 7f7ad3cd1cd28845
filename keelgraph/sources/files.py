"""Reading and writing the pipeline's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelgraph.functions.text import newlines
from keelgraph.operators.ordinals import ordinal
from keelgraph.schemas import CHUNK, ENTITY, TRIPLE


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """(source, text) of every .md file below a folder, with line feeds only. A missing folder is an error."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return files.select(F.col("_metadata.file_path").alias("source"), newlines(F.col("value")).alias("text"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source, line_no, line) of text files, in order within each file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), newlines(F.col("value")).alias("text"))
    return files.select("source", F.posexplode(F.split(F.regexp_replace("text", "\n\\z", ""), "\n")).alias("line_no", "line"))


def read_chunks(spark: SparkSession, path: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Chunks of JSON lines whose ordinal is in [start, end)."""
    chunks = spark.read.schema(CHUNK).json(path).where(F.col("metadata") >= start)
    return chunks if end is None else chunks.where(F.col("metadata") < end)


def _arrays(spark: SparkSession, folder: str, schema: T.StructType, glob: str) -> DataFrame:
    """Rows of JSON-array files with their file's name and place in it; a file that is no JSON gives one row with _corrupt."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(full).json(folder, multiLine=True, pathGlobFilter=glob, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    return rows.select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("position"))


def read_entities(spark: SparkSession, folder: str, glob: str = "entities_*.json") -> DataFrame:
    """Knowledge base records of all range files, with file and position; those that are no JSON in `_corrupt`."""
    return _arrays(spark, folder, ENTITY, glob)


def read_triples(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    return _arrays(spark, folder, TRIPLE, glob)


def good(rows: DataFrame) -> DataFrame:
    return rows.where("_corrupt IS NULL").drop("_corrupt")


def corrupt(rows: DataFrame) -> DataFrame:
    """(file, _corrupt): the files that were skipped."""
    return rows.where("_corrupt IS NOT NULL").select("file", "_corrupt")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, everything as the schema says: only an empty field is null, a name `NA` is a name."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', nullValue="")


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, name, length) of a folder's files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_json_arrays(rows: DataFrame, path: str, range_column: str = "range_start") -> None:
    """One JSON array of each range's rows, in a folder of the range's own; a range is as small as its batch of chunks."""
    own = F.struct(*[c for c in rows.columns if c != range_column])
    listed = rows.groupBy(range_column).agg(F.to_json(F.collect_list(own)).alias("value"))
    listed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(range_column).text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def write_range(rows: DataFrame, path: str, range_column: str = "range_start") -> None:
    """Rows under their range; ranges that come again replace what was there, others stay. A repeated run changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(range_column).parquet(path)


def write_edges_in_order(edges: DataFrame, path: str, order: list[str]) -> None:
    """Edge rows with their place, so that a later fix by place finds the same rows."""
    ordinal(edges, order).write.mode("overwrite").parquet(path)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Both tables of a graph, whatever was there being cleared: nodes sorted by name within files, edges by relation.

    The sorting lets a lookup by name or relation skip most of the files, as an index would.
    """
    nodes.sortWithinPartitions("name").write.mode("overwrite").parquet(f"{path}/nodes")
    edges.sortWithinPartitions(F.col("`:TYPE`")).write.mode("overwrite").parquet(f"{path}/edges")
