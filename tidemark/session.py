"""Session settings used by tests, the bench and stand-alone jobs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC clock, AQE and runtime skew handling on.

    Nothing here is needed by the operators themselves: they work on
    zone-less New York wall clocks and leave join strategy to Catalyst and AQE.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_session(cpus: int | None = None, memory: str = "12g") -> SparkSession:
    n = cpus or os.cpu_count() or 4
    return build_session(
        master=f"local[{n}]",
        **{"spark.sql.shuffle.partitions": str(n), "spark.driver.memory": memory,
           # tiny local tables: do not merge CPU-bound window partitions into one task
           "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"},
    )
