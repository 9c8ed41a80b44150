"""Shared by the operators: tables, stages in the shared folder, numbering, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..sources.sinks import shared_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme; one without lies in the cluster's default file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.toUri().getScheme() is None:
        path = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def stage(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder: later steps read it and survive lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column | str) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def number_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows with ``row_no``: 0, 1, ... in the order of ``keys``, then of all other columns; staged.

    Range partitions are sorted on their own and written once; partition counts give the offsets. Equal
    rows are spread by a salt, so no key has to fit one task; they are alike, so any order of them is right.
    """
    order = [*keys, *(c for c in df.columns if c not in keys), "_salt"]
    parts = (
        df.withColumn("_salt", F.monotonically_increasing_id() % 1009)
        .repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt")
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    )
    rows = stage(parts, name)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return rows.join(offsets, "_part").withColumn("row_no", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Smallest node reachable from each linked node: (node, component) from links (a, b).

    Labels move along links and then jump to the label of their label; each round is a written table.
    """
    both = stage(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), name)
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("low"))
        nearer = labels.join(seen, F.col("node") == F.col("a"), "left").select(
            "node", F.col("component").alias("was"), F.least("component", "low").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        after = stage(nearer.join(jump, "via", "left").select("node", "was", F.least("via", "far").alias("component")), name)
        moved = after.where("component < was").limit(1).count()
        labels = after.select("node", "component")
        if not moved:
            return labels
