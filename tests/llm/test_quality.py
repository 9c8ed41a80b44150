import random
import zlib

import pyarrow as pa
import pytest

from tidemark.llm import quality as Q
from tidemark.llm.words import slices


def corpus(n, seed=1):
    """Plain sentences, and shouting or repeating ones that are marked 0."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("aeinorst", k=rng.randint(2, 7))) for _ in range(rng.randint(20, 60))]
        bad = rng.random() < 0.3
        if bad:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else words[:6] * 6
        rows.append((i, " ".join(words), int(not bad)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, t, "x", 0.7) for i, t, _ in rows] + [(None, None, "x", 0.1), (5000, "", "x", 0.2), (5001, "w " * 100_000, "x", 0.3)],
                                 "doc_id bigint, text string, source string, score double")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (7, None, 0), (9999, 0, 1)], "doc_id bigint, quality int, toxic int")
    return docs, labels, {i: q for i, _, q in rows}


def test_held_out_rows_are_told_apart(tables):
    docs, labels, truth = tables
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
    assert sorted(map(str, got)) == sorted(map(str, Q.quality_scores(docs.repartition(5), labels).collect()))


def test_labels_of_held_out_rows_are_never_learned(spark, tables):
    docs, labels, truth = tables
    other = labels.withColumn("quality", Q.F.when(Q.held_out("doc_id"), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    a, b = Q.quality_model(docs, labels), Q.quality_model(docs, other)
    assert (a[0] == b[0]).all() and a[1] == b[1]


def test_kept_rows_keep_their_columns(tables):
    docs, labels, _ = tables
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["score"] for r in kept.collect()} <= {0.7, 0.1, 0.2, 0.3}


def test_without_labels_or_rows(spark, tables):
    docs, labels, _ = tables
    assert {r["score"] for r in Q.quality_scores(docs.limit(4), labels.limit(0)).collect()} == {0.5}
    assert Q.quality_scores(docs.limit(0), labels).count() == 0


def test_a_text_scores_alike_wherever_it_stands():
    texts = ["Plain words here.", "", "ENDS with", "starts Here", "x" * 10]
    counts = []
    for part in ([t] for t in texts):
        for _, _, data, offsets in slices(pa.array(part)):
            counts.append(sorted(Q.features(data, offsets)[1].tolist()))
    for _, _, data, offsets in slices(pa.array(texts)):
        owner, bucket, _ = Q.features(data, offsets)
    assert [sorted(bucket[owner == i].tolist()) for i in range(len(texts))] == counts
