"""Neighbours of fingerprints: counts and classes against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import simhash as S


@pytest.mark.parametrize("chunk", [1024, 7])
def test_counts_and_classes_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    rng = random.Random(9)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in prints[:25]:
        for flips in (0, 0, 1, 2, 3, 4, 6):
            x = p
            for bit in rng.sample(range(64), flips):
                x ^= 1 << bit
            prints.append(x)
    rows = [p - (1 << 64) if p >> 63 else p for p in prints]
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    got = {r["fingerprint"]: (r["n_near"], r["near_class"]) for r in S.neighbours(spark.createDataFrame([(p,) for p in rows], "fingerprint bigint")).collect()}
    want = {}
    for p in set(rows):
        reached, todo = {p}, [p]
        while todo:
            a = todo.pop()
            more = {b for b in rows if near(a, b)} - reached
            reached |= more
            todo += more
        want[p] = (sum(near(p, b) for b in rows) - 1, min(reached))
    assert got == want
    distinct = sorted(set(rows))
    links = sorted(map(tuple, S.near_links(spark.createDataFrame([(p,) for p in rows], "fingerprint bigint")).collect()))
    assert links == [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if near(a, b)]


def test_copies_are_near(spark):
    texts = ["one two three four"] * 3 + ["One  two THREE four"] + [f"{w} stands alone here" for w in ("salt", "iron")] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in S.compared(docs).collect()}
    assert len(got) == len(texts) and [got[i]["n_near"] for i in range(8)] == [3, 3, 3, 3, 0, 0, 1, 1]
    assert [got[i]["near_found"] for i in range(8)] == [True] * 4 + [False] * 2 + [True] * 2
    assert len({got[i]["near_class"] for i in range(4)}) == 1 and len({got[i]["near_class"] for i in range(8)}) == 4


def test_a_group_of_near_copies_makes_few_links(spark, monkeypatch):
    """A ball of 500 fingerprints, all near each other, and chains: one class each, links by member and not by pair."""
    rng, kept = random.Random(3), []
    middle = rng.getrandbits(63)
    ball = list({middle ^ (1 << a) for a in range(63)} | {middle} | {middle ^ (1 << a) ^ (1 << 60) for a in range(60)})
    chain = [rng.getrandbits(62)]
    for k in range(20):
        chain.append(chain[-1] ^ (7 << 3 * k))  # three bits a step
    monkeypatch.setattr(S, "components", lambda links, name, real=S.components: real(kept.append(links.count()) or links, name))
    prints = [(p,) for p in ball + chain]
    got = {r["fingerprint"]: r for r in S.neighbours(spark.createDataFrame(prints, "fingerprint bigint")).collect()}
    near = lambda a, b: (a ^ b).bit_count() <= 3
    assert all(got[p]["n_near"] == sum(near(p, q) for (q,) in prints) - 1 for (p,) in prints)
    assert {got[p]["near_class"] for p in ball} == {min(ball)} and {got[p]["near_class"] for p in chain} == {min(chain)}
    assert kept[0] < 4 * len(prints)


def test_block_tables_and_rows_are_not_broadcast(spark, monkeypatch):
    """Twenty rows of each fingerprint are sized as one, so at 0.6 GB of texts they passed for less than 10 MB."""
    kept = {}
    monkeypatch.setattr(S, "stage", lambda df, name, real=S.stage: real(kept.setdefault(name, df), name))
    prints = spark.range(300).select(F.xxhash64("id").alias("fingerprint"))
    S.neighbours(prints)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for df, joins in ((kept["near"], 3), (S.with_near(prints), 1), (S.near_queries(prints, prints), 1), (S.near_links(prints), 1)):
        assert "Broadcast" not in plan(df) and plan(df).count("SortMergeJoin [") == joins
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", "id", F.lit("a b")).alias("text"))
    assert "SortMergeJoin [next_run" in plan(S.compared(docs))
