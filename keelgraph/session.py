"""Session, input tables and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "keelgraph", cpus: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitted configuration is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cpus or '*'}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KEELGRAPH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores, for work that is heavy for the bytes it reads.

    Only a scan of few splits is shuffled; one of many is left as it is, and so is what comes out of a shuffle, whose
    partitions can't be counted without running it.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Folders of intermediate tables that `release` deletes.
_made: list[str] = []


def _shared_folder(spark: SparkSession) -> str:
    """The session's shared folder (spark.checkpoint.dir). Only in local mode, as in tests, may it be missing."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="keelgraph-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """The rows of df as a table written to the shared folder: worked out once, however often and by whichever columns it is read.

    Its lineage ends at the files, so a lost executor costs only its running tasks.
    """
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes the intermediate tables written so far; to be called when the results that read them are written."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(hadoop).delete(path, True)
