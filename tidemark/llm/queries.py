"""The queries of the operators over the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import encoded, vocabulary_size
from .chat import read_back, windows
from .common import table
from .fill_middle import restored, transformed
from .hard_negatives import hard_negatives
from .licenses import scanned
from .mixing import mixed
from .multi_index import nearest_neighbours
from .near_dedup import near_groups
from .oracle import ORACLE
from .pivot_search import top_products
from .quality import quality_scores
from .sharding import sharded
from .simhash import compared
from .token_output import materialised

__all__ = ["QUERIES", "ORACLE"]
QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PROBE = "<|im_end|><|im_start|>assistant ok"


@query
def op1_chat(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1).alias("role"), F.lit(PROBE).alias("text"))
    found = read_back(windows(turns.unionByName(probe)))
    return found.select("conv_id", F.col("n_turns").cast("bigint").alias("n_turns"), F.sha2("turns_text", 256).alias("turns_sha256"),
                        F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


@query
def op2_top_products(spark: SparkSession, d: str) -> DataFrame:
    """Components scaled to floor(256 x); queries are the rows whose vec_id is divisible by 50."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    vectors = table(spark, d, "embeddings").where(fine).select("vec_id", whole.alias("vector"))
    return top_products(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op3_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_groups(table(spark, d, "documents"))


@query
def op4_licenses(spark: SparkSession, d: str) -> DataFrame:
    return scanned(table(spark, d, "documents")).drop("blocks")


@query
def op5_bpe(spark: SparkSession, d: str) -> DataFrame:
    docs = encoded(table(spark, d, "documents").select("doc_id", "text"), tokenizer_path())
    line = F.array_join(F.col("ids").cast("array<string>"), " ")
    return docs.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(line, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_sharding(spark: SparkSession, d: str) -> DataFrame:
    rows = sharded(table(spark, d, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    return compared(table(spark, d, "documents"))


@query
def op8_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_token_output(spark: SparkSession, d: str) -> DataFrame:
    """Every sequence of tokenizer ids and its place in the shards, read back from them."""
    path = tokenizer_path()
    ids = encoded(table(spark, d, "documents").select("doc_id", "text"), path, with_text=False, in_bytes=True).select("doc_id", "ids")
    return materialised(ids, vocabulary=vocabulary_size(path))


@query
def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op11_fill_middle(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the reordered texts and of the texts rebuilt from them."""
    rows = restored(transformed(table(spark, d, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


@query
def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    """Components scaled to floor(256 x), labels of every seventh row moved on by one; every hundredth row is an anchor."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    label = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label")
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("vector")
    rows = table(spark, d, "embeddings").where(fine).select("vec_id", label, scaled)
    return hard_negatives(rows, rows.where("vec_id % 100 = 0"))


@query
def op13_multi_index(spark: SparkSession, d: str) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 50."""
    vectors = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"))
