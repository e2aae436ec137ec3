"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The feature table is wider than the default limit for whole-stage code.
    "spark.sql.codegen.maxFields": "200",
    # Lets a join on (series, week) reuse a partitioning on the series alone.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(app: str = "shelfspan", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings this library is tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="shelfspan-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/shelfspan/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage, survives lost executors, and gives the planner the real
    size of the result, so later joins choose their strategy from facts.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a settled table that nothing reads any more; other tables are left alone."""
    spark = df.sparkSession
    root = f"{shared_folder(spark)}/shelfspan/"
    tail = root.rpartition(":")[2].lstrip("/")
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if tail in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
