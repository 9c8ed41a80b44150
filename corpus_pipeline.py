"""A corpus made ready for training: quality, near copies, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the shared
folder and read again as the docs of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.bpe import encoded
from tidemark.llm.common import new_path, table
from tidemark.llm.mixing import mixture
from tidemark.llm.near_dedup import drop_near_copies
from tidemark.llm.quality import keep_good
from tidemark.llm.queries import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a document stands in it up to twice, or not at all."""
    return mixture(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of what they decode to."""
    rows = encoded(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    line = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(line, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", to_weights),
    ("BPE encoding and decoding", token_ids),
]

# Training, components and knapsack have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
