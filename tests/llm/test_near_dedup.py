import random

import numpy as np
import pytest

from brute import near_groups as brute
from tidemark.llm import near_dedup as N
from tidemark.llm.common import components

SCHEMA = "doc_id bigint, text string"


def found(spark, rows, schema=SCHEMA):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_groups(spark.createDataFrame(rows, schema)).collect()}


def corpus(seed, bases=5, copies=24, edits=6, length=40):
    """Bases and copies of them with more and more words changed, around the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = {}
    for b in range(bases):
        base = rng.choices(vocabulary, k=rng.randint(4, length))
        for c in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits) * (c > 0)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs[len(docs)] = " ".join(text)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    docs = corpus(seed)
    assert found(spark, list(docs.items())) == brute(docs)


def test_hot_group_is_compared_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "PROBES", 3)
    monkeypatch.setattr(N, "BASES", 4)
    docs = corpus(5, bases=1, copies=90, edits=7, length=60)
    assert found(spark, list(docs.items())) == brute(docs)


def test_nulls_empty_short_and_repeated_rows(spark):
    long = "one two three four five six seven " * 3
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One  two"), (5, "one\ttwo"), (6, long), (7, long.upper()), (7, long.upper()), (None, long), (8, "é É")]
    got = N.near_groups(spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id bigint, text string, kept string, component_id int")).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0] and all(by_id[i]["kept"] for i in (1, 2, 3, 4, 6, 8, None))
    assert by_id[5]["component_id"] == 4 and by_id[7]["component_id"] == 6 and not by_id[7]["kept"]
    assert by_id[None]["component_id"] is None


def test_empty_table_and_very_long_text(spark):
    assert found(spark, []) == {}
    text = " ".join(f"t{i % 70_000}" for i in range(150_000))
    assert {i: c for i, (_, c) in found(spark, [(1, text), (2, text + " end"), (3, "t1 t2")]).items()} == {1: 1, 2: 1, 3: 3}


def test_rows_kept_keep_their_columns(spark):
    text = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, text, "x"), (2, text, "y"), (None, text, None)], "doc_id bigint, text string, _kept string")
    assert sorted(N.drop_near_copies(docs).collect(), key=str) == sorted([docs.collect()[0], docs.collect()[2]], key=str)


def test_sketch_limit_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(4)
    limit, over = N.sketch_limit(75), 0
    for _ in range(300):
        shared = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        own = rng.integers(0, 1 << 63, (2, 25), dtype=np.uint64)
        sketch = N.odd_sketches(N.samples([np.concatenate((shared, x)) for x in own]))
        over += int(np.bitwise_count(sketch[0] ^ sketch[1]).sum()) > limit
    assert over == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    assert {r["node"]: r["component"] for r in components(links).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
