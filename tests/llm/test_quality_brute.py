"""Training and scores against plain loops: one weight at a time, one text at a time."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from test_quality import corpus
from tidemark.llm import quality as Q
from tidemark.llm.words import slices

TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+")


def examples(texts):
    """(bucket -> value) of each text: occurrences over the root of its number of tokens."""
    out = []
    for text in texts:
        for _, _, data, offsets in slices(pa.array([text], pa.large_string())):
            _, bucket, _ = Q.features(data, offsets)
            tokens = len(TOKEN.findall(text.encode()))
            out.append({b: n / math.sqrt(max(1, tokens)) for b, n in sorted(Counter(bucket.tolist()).items())})
    return out


def leader(rows, labels):
    """Follow the regularised leader, written out by its formulas."""
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= Q.L1:
            return 0.0
        return (math.copysign(Q.L1, z[i]) - z[i]) / ((Q.BETA + math.sqrt(n[i])) / Q.ALPHA + Q.L2)

    for _ in range(Q.EPOCHS):
        for row, label in zip(rows, labels):
            row = row | {"bias": 1.0}
            w = {i: weight(i) for i in row}
            total = sum(w[i] * x for i, x in row.items())
            error = 1 / (1 + math.exp(-max(-30, min(30, total)))) - label
            for i, x in row.items():
                g = error * x
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / Q.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


@pytest.fixture(scope="module")
def model():
    rows = corpus(50, seed=4) + [(50, "", 1), (51, "a1!b 22 ÄÖ\tx", 0)]
    texts, labels = [t for _, t, _ in rows], np.array([q for _, _, q in rows], float)
    return texts, labels, Q.train(texts, labels)


def test_training_equals_plain_loops(model):
    texts, labels, (weights, bias) = model
    want = leader(examples(texts), labels.tolist())
    assert bias == pytest.approx(want.pop("bias"), abs=1e-5)
    held = {i: w for i, w in want.items() if w}
    assert set(np.flatnonzero(np.abs(weights) > 1e-4).tolist()) <= set(held)
    assert len(held) > 50 and all(weights[i] == pytest.approx(w, abs=1e-4) for i, w in want.items())


def test_scores_are_dot_products(spark, model):
    texts, _, (weights, bias) = model
    texts = [*texts, None, "w " * 30_000, texts[0], texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in Q.scored(docs, weights, bias).collect()}
    for i, row in enumerate(examples([t or "" for t in texts])):
        total = sum(weights[b] * x for b, x in row.items()) + bias
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, total)))), abs=1e-9)
    assert got[0] == got[len(texts) - 1] == got[len(texts) - 2]
