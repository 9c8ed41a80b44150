"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters, digits or other characters between white space; case stays, digits are
alike. Features are hashed one- and two-token sequences, and one- to three-token sequences of word
shapes (kind, case, length class), so that unseen words count too. A token sequence seen before in
the same text also yields a feature of its own. A score is the sigmoid of one sparse dot product.

Training takes a bounded sample of the labelled rows (``SAMPLE``, a rate of their hashed ids), split by
hash into ``SHARDS`` parts that are trained side by side and averaged. Scoring reads whole texts of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .words import LOWER, SPACE, U, mix, runs, sequence_hashes, slices, span_hashes

BUCKETS = 1 << 18
SAMPLE, SHARDS, EPOCHS = 8_000, 4, 4
ALPHA, BETA, L1, L2 = 0.15, 1.0, 0.02, 1.0  # learning rate, smoothing and penalties of the training

_KIND = np.full(256, 3, np.uint8)  # 1 letters, 2 digits, 3 other characters, 0 white space
_KIND[SPACE] = 0
_KIND[48:58] = 2
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_SAME = np.arange(256, dtype=np.uint8)
_SAME[48:58] = 48
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1


def _bucket(hashes: np.ndarray, space: int) -> np.ndarray:
    return (mix(hashes + U(space)) % U(BUCKETS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every feature occurrence, and the number of tokens of each text."""
    n_texts = len(offsets) - 1
    starts, ends = runs(_KIND[data], offsets)
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    text = np.repeat(np.arange(n_texts), count)
    if not len(starts):
        return text, text, count
    kind = _KIND[data[starts]].astype(np.int64)
    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    n_upper, long = upper[ends] - upper[starts], ends - starts
    case = np.where(n_upper == 0, 0, np.where(n_upper == long, 3, np.where(_UPPER[data[starts]] & (n_upper == 1), 1, 2)))
    glued = np.concatenate(([0], ((starts[1:] == ends[:-1]) & (text[1:] == text[:-1])).astype(np.int64)))  # no white space before
    shape = (kind * 64 + case * 16 + np.minimum(np.digitize(long, (2, 3, 5, 8, 13)), 7) * 2 + glued).astype(U)
    shape_hash, token = mix(shape + U(99)), span_hashes(_SAME[data], starts, ends)
    low = span_hashes(LOWER[data], starts, ends)
    texts, buckets = [text, text], [_bucket(token, 1), _bucket(shape_hash, 2)]
    for n, source, space in ((2, token, 3), (2, shape_hash, 4), (3, shape_hash, 5), (4, low, 6)):
        if len(source) < n:
            continue
        joined = sequence_hashes(source, n)
        inside = text[n - 1 :] == text[: len(text) - n + 1]
        owner = text[n - 1 :][inside]
        joined = joined[inside]
        if space == 6:  # only whether it was seen before
            joined = mix(joined + owner.astype(U))
            order = np.argsort(joined, kind="stable")
            again = order[1:][joined[order][1:] == joined[order][:-1]]
            owner, found = owner[np.sort(again)], np.full(len(again), int(_bucket(np.ones(1, U), 6)[0]))
        else:
            found = _bucket(joined, space)
        texts.append(owner)
        buckets.append(found)
    return np.concatenate(texts), np.concatenate(buckets), count


def train(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the bias after EPOCHS passes in the order given."""
    examples = []
    for at, to, data, offsets in slices(pa.array(texts, pa.large_string())):
        owner, bucket, count = features(data, offsets)
        order = np.argsort(owner, kind="stable")
        bucket, cut = bucket[order], np.searchsorted(owner[order], np.arange(to - at + 1))
        for k in range(to - at):
            idx, times = np.unique(bucket[cut[k] : cut[k + 1]], return_counts=True)
            examples.append((idx.astype(np.int32), (times / np.sqrt(max(1, count[k]))).astype(np.float32)))
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(idx):
        zi, ni = z[idx], n[idx]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for (idx, x), y in zip(examples, labels):
            idx = np.append(idx, BUCKETS)
            x = np.append(x, 1.0)
            w = weights(idx)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            sigma = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / ALPHA
            z[idx] += g - sigma * w
            n[idx] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], float(w[-1])


def fit(labelled: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Average weights from labelled rows (doc_id, text, label 0 or 1), of which ``labelled`` holds about ``sample``."""

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["at", "doc_id", "text"])
        w, b = train(rows["text"].tolist(), rows["label"].to_numpy(float))
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "n": [len(rows)], "bias": [b], "w": [w.astype("<f4").tobytes()]})

    rows = labelled.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"),
                           F.xxhash64("doc_id", F.lit(11)).alias("at"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SHARDS)))
    # SHARDS rows of one weight table each, whatever the input's size
    parts = rows.groupBy("shard").applyInPandas(shard, "shard long, n long, bias double, w binary").orderBy("shard").collect()
    if not parts:
        return np.zeros(BUCKETS), 0.0
    share = np.array([p["n"] for p in parts], float)
    share /= share.sum()
    w = sum(s * np.frombuffer(p["w"], "<f4").astype(float) for s, p in zip(share, parts))
    return w, float(sum(s * p["bias"] for s, p in zip(share, parts)))


def scored(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """``docs`` with score (0 to 1) of each whole text; null text counts as empty. An own column score gives way."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS numbers
    at = docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(at)):
                owner, bucket, count = features(data, offsets)
                total = np.bincount(owner, weights=w[bucket], minlength=b - a) / np.sqrt(np.maximum(1, count)) + bias
                score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*batch.schema.names, "score"])

    fields = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(of, fields)


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels are never learned from."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on labelled documents outside the held-out third.

    Labels that are null or neither 0 nor 1 are not used. Without usable labels all weights are 0, every score 0.5.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("label"))
    known = known.where(~held_out("doc_id") & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    n = known.count()
    rate = min(1.0, sample / max(1, n))
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_003)) < F.lit(int(rate * 1_000_003) + 1))
    picked = picked.groupBy("doc_id").agg(F.max("label").alias("label"))
    # about ``sample`` small rows, so the texts need no shuffle
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    return fit(rows, sample)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; only the text is scored.

    Null and empty texts get the score of a text without features; repeated rows get equal scores.
    """
    weights, bias = quality_model(docs, labels, sample)
    found = scored(docs.select("doc_id", "text"), weights, bias)
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out("doc_id").alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents with a score of 0.5 or more, all columns as they are."""
    weights, bias = quality_model(docs, labels, sample)
    return scored(docs.withColumnRenamed("score", "_own_score"), weights, bias).where("score >= 0.5").drop("score").withColumnRenamed("_own_score", "score")
