import random
from itertools import combinations_with_replacement

import numpy as np
import pytest

from brute import targets as brute_targets, words
from tidemark.llm.mixing import NEW, fit_lengths, mixed, mixture


@pytest.mark.parametrize("seed", range(6))
def test_subset_sum_is_as_near_as_any(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(1, 30), 4)))
    counts = np.array([rng.randint(0, 3) for _ in lengths])
    sums = {0}
    for length, n in zip(lengths.tolist(), counts.tolist()):
        sums = {s + k * length for s in sums for k in range(n + 1)}
    for budget in range(0, int((lengths * counts).sum()) + 1, 3):
        taken = fit_lengths(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        assert abs(int((taken * lengths).sum()) - budget) <= int(lengths.max())
    assert list(combinations_with_replacement("ab", 2))  # the sums above are those of bounded choices


def test_many_lengths_are_fitted_to_the_word():
    rng = np.random.default_rng(3)
    lengths = np.unique(rng.integers(1, 9000, 2000))
    counts = rng.integers(1, 60, len(lengths))
    total = int((lengths * counts).sum())
    for share in (0.001, 0.37, 0.9):
        budget = int(total * share)
        assert int((fit_lengths(lengths, counts, budget) * lengths).sum()) == budget


def test_mixture_of_sources(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "c", "d", "ü", None, "s", "n"])) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", None), (None, "x y", "b")]
    docs = spark.createDataFrame([(*r, "size") for r in rows], "doc_id bigint, text string, source string, size string")
    got = mixed(docs).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    goal = brute_targets(sizes)
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] and r["copies"] in (0, 1, 2)
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixed(docs.repartition(3)).collect()))
    rows_out = mixture(docs)
    assert rows_out.columns == docs.columns and rows_out.count() == sum(r["copies"] for r in got)


def test_equal_rows_tie_without_loss(spark):
    docs = spark.createDataFrame([(7, "a b c", "x")] * 90 + [(1, "a b c d", "y")] * 10, "doc_id bigint, text string, source string")
    got = mixed(docs).collect()
    assert len(got) == 100
    for s, goal in brute_targets({"x": 270, "y": 40}).items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - goal) <= 2


def test_empty(spark):
    assert mixed(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0
    got = mixed(spark.createDataFrame([(1, None, None)], "doc_id bigint, text string, source string")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)]


CLASHING = ["passes", "extra", "n", "_at", "_src", "_edge", "_in", "_copy", "copies", "Size", "taken", "part", "need", "c0", "c1", "_own_size", "a.b"]


def test_further_columns_of_any_name_stay(spark):
    rows = [(i, "w " * (i % 7), "ab"[i % 2], *[f"{c}{i}" for c in CLASHING]) for i in range(60)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *CLASHING])
    plain = docs.select("doc_id", "text", "source")
    got = mixed(docs)
    assert got.columns == ["doc_id", "text", "source", *(c for c in CLASHING if c.lower() not in NEW), *NEW]
    assert sorted((r["doc_id"], r["taken"], r["target"]) for r in got.collect()) == sorted((r["doc_id"], r["taken"], r["target"]) for r in mixed(plain).collect())
    out = mixture(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == sorted(rows[r["doc_id"]] for r in mixture(plain).collect())
