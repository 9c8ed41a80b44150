"""Writers: fixed-order CSV, JSON lines, keyed upsert into versioned tables."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.joins import last_wins
from ..shared import remove_path, scratch_path, shared_dir

__all__ = ["shared_dir", "remove_path", "scratch_path", "write_csv", "write_jsonl", "column_manifest", "check_keys", "upsert", "upsert_path",
           "read_upserted", "versions", "drop_versions", "ConcurrentUpsert"]

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> str:
    """CSV with header in a fixed column order; other columns drop. The committer makes it atomic."""
    writer = df.select(*columns).write.mode("error").option("header", True).option("escape", '"')
    writer.option("timestampNTZFormat", MICROS).option("timestampFormat", MICROS + "XXX").csv(path)
    return path


def write_jsonl(df: DataFrame, path: str) -> str:
    """Cleaned rows as JSON lines, null fields kept."""
    writer = df.write.mode("error").option("ignoreNullFields", "false")
    writer.option("timestampNTZFormat", MICROS).option("timestampFormat", MICROS + "XXX").json(path)
    return path


def column_manifest(df: DataFrame) -> DataFrame:
    """Column names and types of a table, as rows."""
    names = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
                      for i, f in enumerate(df.schema.fields)])
    return df.sparkSession.range(1).select(F.explode(names).alias("c")).select("c.*")


def check_keys(columns: Sequence[str], keys: Sequence[str]) -> None:
    if not columns:
        raise ValueError("columns are required")
    if not keys:
        raise ValueError("key columns are required")
    missing = [k for k in keys if k not in columns]
    if missing:
        raise ValueError(f"key columns are not output columns: {missing}")
    bad = [c for c in columns if not c.replace("_", "a").isalnum() or c[0].isdigit()]
    if bad:
        raise ValueError(f"invalid identifiers: {bad}")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Target after the batch: batch rows replace target rows of their key, the last duplicate wins.

    With only key columns nothing can change, so existing rows stay.
    """
    columns = target.columns
    check_keys(columns, keys)
    newest = last_wins(batch, list(keys), list(order)).select(*columns)
    if set(columns) == set(keys):
        fresh = newest.join(target, list(keys), "left_anti").select(*columns)
        return target.unionByName(fresh)
    return target.join(newest.select(*keys), list(keys), "left_anti").select(*columns).unionByName(newest)


class ConcurrentUpsert(RuntimeError):
    """Another writer published a version while this one was merging; the batch can be run again."""


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _files(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions of an upserted table, ascending."""
    return sorted(int(n[:-5]) for n in _names(spark, f"{path}/_versions") if n.endswith(".json") and n[:-5].isdigit())


def read_version(spark: SparkSession, path: str, version: int) -> dict:
    """The manifest of a version: its schema and the batch folder that holds each partition."""
    fs, where = _files(spark, f"{path}/_versions/{version:012d}.json")
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    """Write the manifest aside and rename it into place: readers see all of the version or none of it."""
    fs, draft = _files(spark, f"{path}/_versions/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(manifest), "utf-8"))
    finally:
        out.close()
    jvm = spark._jvm
    draft = fs.makeQualified(draft)
    final = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/_versions/{version:012d}.json"))
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, no_overwrite)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise ConcurrentUpsert(f"version {version} of {path} exists") from error
        raise


def read_upserted(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """An upserted table as of a published version, the newest unless given.

    A reader holds on to the files of its version: writers add folders and never touch those of others.
    """
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no version of {path}")
    if version is not None and version not in known:
        raise ValueError(f"version {version} of {path} is not among {known}")
    manifest = read_version(spark, path, known[-1] if version is None else version)
    schema = StructType.fromJson(manifest["schema"])
    folders = [f"{path}/data/{batch}/{name}" for name, batch in sorted(manifest["partitions"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def upsert_path(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str], partition: str) -> int:
    """Upsert a partitioned Parquet table, rewriting only the partitions the batch touches; returns the new version.

    The merged partitions go to a folder of their own, then one manifest that names the folder of every partition
    is published by a rename. A writer that dies before that leaves the old version whole, and the batch can
    be run again; of two writers at once the second gets :class:`ConcurrentUpsert`. A manifest has an entry for each
    partition of the table. The partition column must be part of the key; a null in it is a partition of its own.
    An empty batch publishes a version equal to the one before. Read with :func:`read_upserted`.
    """
    if partition not in keys:
        raise ValueError("the partition column must be a key column")
    columns = [c for c in batch.columns if c not in order or c in keys]
    shape = StructType([StructField(f.name, f.dataType) for f in batch.select(*columns).schema])
    before = versions(spark, path)
    held: dict[str, str] = {}
    target = spark.createDataFrame([], shape)
    if before:
        manifest = read_version(spark, path, before[-1])
        if StructType.fromJson(manifest["schema"]).simpleString() != shape.simpleString():
            raise ValueError(f"the batch does not have the columns of {path}")
        held, target = manifest["partitions"], read_upserted(spark, path, before[-1])
    touched = batch.select(F.col(partition).alias("_touched")).distinct()
    affected = target.join(touched, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
    name = f"_batch={uuid.uuid4().hex}"
    merged = upsert(affected, batch, keys, order).hint("rebalance", partition)  # files by size, however large a partition is
    merged.write.partitionBy(partition).parquet(f"{path}/data/{name}")
    fresh = {folder: name for folder in _names(spark, f"{path}/data/{name}") if folder.startswith(f"{partition}=")}
    version = before[-1] + 1 if before else 1
    _publish(spark, path, version, {"schema": json.loads(shape.json()), "partitions": {**held, **fresh}})
    return version


def drop_versions(spark: SparkSession, path: str, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
    """Forget all but the last ``keep`` versions, then delete batch folders no version names; returns those.

    Folders changed within ``older_than_hours`` stay, as a writer may not have published them yet.
    """
    if keep < 1:
        raise ValueError("at least one version must stay")
    known = versions(spark, path)
    used = {b for v in known[-keep:] for b in read_version(spark, path, v)["partitions"].values()}
    for v in known[:-keep]:
        remove_path(spark, f"{path}/_versions/{v:012d}.json")
    fs, where = _files(spark, f"{path}/data")
    limit = (time.time() - older_than_hours * 3600) * 1000
    old = [f.getPath().getName() for f in fs.listStatus(where) if f.getModificationTime() <= limit] if fs.exists(where) else []
    gone = sorted(set(old) - used)
    for name in gone:
        remove_path(spark, f"{path}/data/{name}")
    return gone
