"""Term lists by their rare letter groups, against a search for every term in every text."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import terms as T


def hits(spark, texts, terms, **names):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, body string")
    listed = spark.createDataFrame([(t,) for t in terms], "term string")
    return sorted(map(tuple, T.term_hits(rows, ["id"], F.col("body"), listed).collect()))


def brute(texts, terms):
    wanted = {t.lower() for t in terms if t}
    wanted = {"".join(c for c in t if c not in "%\\'") for t in wanted} - {""}
    return sorted((i, t) for i, text in enumerate(texts) for t in wanted if t in (text or "").lower())


@pytest.mark.parametrize("few", [0, T.FEW])
def test_all_terms_are_found_anywhere(spark, monkeypatch, few):
    monkeypatch.setattr(T, "PIECE", 16)
    monkeypatch.setattr(T, "FEW", few)  # both ways beyond and below the size of a list that is sent to all tasks
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("abcé ", k=n))
    texts = [word(rng.randint(0, 200)) for _ in range(40)] + [None, "", "a", "Z%'\\", "x\ny.*[", "😀é😀", "ABBA " * 400]
    terms = [word(rng.randint(1, 9)) for _ in range(150)] + ["", None, "Z%", "%", "X\nY.*[", "😀é", "ABBA abba ABBA", "abba " * 30, "nowhere at all"]
    got = hits(spark, texts, terms)
    assert got == brute(texts, terms) and len(got) > 500


def test_empty_lists_and_tables(spark):
    assert hits(spark, ["some text"], []) == [] and hits(spark, ["some text"], [None, "", "%"]) == []
    assert hits(spark, [], ["some"]) == [] and hits(spark, [None, ""], ["some"]) == []


def test_equal_keys_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "alpha", "a", "b"), (1, "alpha beta", "a", "b"), (None, "beta", "a", "b"), (None, "beta", "a", "b")], "term int, body string, gram string, piece string")
    listed = spark.createDataFrame([("Beta", 1), ("beta", 2), ("alpha", 3)], "name string, id int")
    got = T.term_hits(rows.withColumnRenamed("term", "id"), ["id"], F.col("body"), listed, "name")
    assert sorted(map(str, map(tuple, got.collect()))) == ["(1, 'alpha')", "(1, 'beta')", "(None, 'beta')"]
    kept = T.with_any_term(rows.withColumnRenamed("term", "id"), "id", F.col("body"), listed, "name")
    assert kept.columns == ["id", "body", "gram", "piece"] and kept.count() == 2


def test_a_long_list_costs_little_more_than_a_short_one(spark):
    """10,000 terms against ten, on texts of which few hold any: within three times the time, same rows as brute force."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    many = [word() for _ in range(10_000)]
    texts = [" ".join([word() for _ in range(300)] + rng.sample(many, 2)) for _ in range(1000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, body string").repartition(8).cache()
    rows.count()

    def timed(terms):
        listed = spark.createDataFrame([(t,) for t in terms], "term string")
        start = time.perf_counter()
        found = T.term_hits(rows, ["id"], F.col("body"), listed).collect()
        return found, time.perf_counter() - start

    timed(many[:10])  # warm
    _, short = timed(many[:10])
    found, long = timed(many)
    rows.unpersist()
    held = {(i, t) for i, text in enumerate(texts) for t in set(text.split()) & set(many)}
    assert held <= set(map(tuple, found)) and all(t in texts[i] for i, t in found)
    assert long < 3 * short, (long, short)


def test_slices_and_common_beginnings(spark, monkeypatch):
    monkeypatch.setattr(T, "FEW", 40)
    rng = random.Random(8)
    terms = [f"http://www.example.org/{'a' * rng.randint(0, 60)}{i}" for i in range(150)] + ["h", "http", "http://", "org/" * 30]
    texts = [" ".join(rng.sample(terms, 5)) for _ in range(30)] + [terms[0][:-1], "http://www.example.org/" * 9]
    assert hits(spark, texts, terms) == brute(texts, terms)


def test_a_list_beyond_one_broadcast_shuffles_no_candidates(spark, monkeypatch):
    monkeypatch.setattr(T, "FEW", 40)
    rows = spark.createDataFrame([(1, "the there"), (2, "ether")], "id bigint, body string")
    listed = spark.createDataFrame([(f"the {i}",) for i in range(100)] + [("the",), ("ther",)], "term string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = T.term_hits(rows, ["id"], F.col("body"), listed)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(1, "the"), (1, "ther"), (2, "the"), (2, "ther")]
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
