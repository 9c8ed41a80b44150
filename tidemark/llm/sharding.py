"""Shards with row counts at most one apart: a keyed permutation of global row numbers deals rows out.

Rows are numbered in the order of doc_id; the permuted number p gives shard p mod k and slot p div k. Both
can be computed for any row from its number alone, and a rerun deals alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import number_rows
from .permutation import permuted

SHARDS, SEED = 24, 2024


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, row_no, shard and slot for every row of ``docs`` (doc_id, text).

    size is the text's UTF-8 bytes plus 8; null text has none, and the checksum of no bytes. Rows without
    doc_id come first. Rows that share a doc_id are ordered by checksum and size; equal rows are
    interchangeable. Further columns drop.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.crc32(text).alias("text_crc32"),
                       (F.octet_length(text) + 8).cast("bigint").alias("size"))
    rows = number_rows(rows, ["doc_id", "text_crc32", "size"], "numbered")
    n = rows.count()
    rows = rows.withColumn("_p", permuted("row_no", n, seed))
    return rows.select("doc_id", "size", "text_crc32", "row_no", (F.col("_p") % shards).cast("int").alias("shard"),
                       F.expr(f"_p div {shards}").alias("slot"))
