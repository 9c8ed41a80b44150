"""The folder that driver and executors share, and tables written there for several readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only local mode may go without: there a temporary folder is made and set. On a cluster it is an error,
    as executors would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir("file:" + tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a stage that is no longer read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """A table that several branches read, written once to the shared folder.

    Plans above it start from a scan, and a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
