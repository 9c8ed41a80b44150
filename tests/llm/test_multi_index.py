import math
import os

import numpy as np
import pytest

from tidemark.llm import multi_index as M

SCHEMA = "vec_id bigint, vector array<double>"
SMALL = "/root/testdata/sf0.1"


def brute(vectors, queries, k=5):
    width = max((len(v) for v in [*vectors.values(), *queries.values()]), default=0)
    full = lambda v: np.array([*v, *[0.0] * (width - len(v))])
    out = {}
    for q, x in queries.items():
        x = full(x)
        score = {i: float(x @ full(v) / (np.linalg.norm(x) * np.linalg.norm(full(v)))) for i, v in vectors.items() if i != q}
        out[q] = sorted(((i, s) for i, s in score.items()), key=lambda t: (-round(t[1], 12), t[0]))[:k]
    return out


def search(spark, rows, queries, k=5, **options):
    got = M.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(queries, SCHEMA), k, **options).orderBy("query_id", "rank").collect()
    out = {}
    for r in got:
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got[q], want[q]))


def clustered(n, width=10, seed=1, groups=20):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (groups, width))
    return {i: (middles[i % groups] + rng.normal(0, 0.3, width)).tolist() for i in range(n)}


@pytest.mark.parametrize("small", [False, True])
def test_whole_reach_is_exact(spark, monkeypatch, small):
    if small:  # rows of cells are split, parts copied, queries scored in bunches
        for name, value in (("ROWS", 16), ("QUERIES", 7), ("BUNCH", 3)):
            monkeypatch.setattr(M, name, value)
    vectors = clustered(300) | {1000 + i: [1.0, 2.0, 0.0, -1.0, 0.5, 0.0, 0.0, 3.0, 1.0, 1.0] for i in range(150)}  # one vector many times
    queries = {i: v for i, v in vectors.items() if i % 15 == 0}
    same(search(spark, list(vectors.items()), list(queries.items()), reach=1.0), brute(vectors, queries))


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_fitted_recall_and_reach_on_clusters(spark):
    vectors = clustered(4000, groups=80)
    queries = {i: v for i, v in vectors.items() if i % 50 == 0}
    want = brute(vectors, queries)
    got = search(spark, list(vectors.items()), list(queries.items()))
    assert recall(got, want) >= 0.95 and all(len(w) == 5 for w in got.values())
    scaled = M.unit(np.array(list(vectors.values())))
    assert M.fitted_reach(M.Quantiser(scaled[::2], 32), scaled[1::2], 5, M.TARGET) < 0.25  # near rows lie in few cells


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables absent")
def test_recall_of_the_query(spark):
    from tidemark.llm.queries import op13_multi_index

    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r[0]: [float(x) for x in r[1]] for r in rows}
    want = brute(vectors, {i: v for i, v in vectors.items() if i % 50 == 0})
    got = {}
    for r in op13_multi_index(spark, SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys() and recall(got, want) >= 0.95
    exact = {q: dict(brute({i: vectors[i] for i, _ in found}, {q: vectors[q]}, 99)[q]) for q, found in got.items()}
    assert all(abs(exact[q][i] - s) < 1e-12 for q, found in got.items() for i, s in found)


def test_copies_and_ties_go_to_the_smaller_id(spark):
    vectors = {i: [1.0, 0.0] for i in range(40)} | {100 + i: [0.0, 1.0] for i in range(40)} | {200: [2.0, 0.0], 201: [1.0, 1.0]}
    queries = {i: vectors[i] for i in (0, 3, 100, 201)}
    got = search(spark, list(vectors.items()), list(queries.items()), reach=1.0)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[3]] == [0, 1, 2, 4, 5] and [i for i, _ in got[201]] == [0, 1, 2, 3, 4]


def test_unusable_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [9.0, 9.0]), (6, [2.0, 2.0]), (6, [2.0, 2.0]), (7, []), (8, [5.0]), (9, [0.0, 0.0]),
            (10, [1e200, -1e200]), (11, [2.0**-1000, 2.0**-999])]
    whole = {1: [1, 2], 6: [2, 2], 8: [5], 10: [1, -1], 11: [1, 2]}
    same(search(spark, rows, rows), brute(whole, whole))
    assert search(spark, [(1, [1.0])], [(1, [1.0])]) == {} and search(spark, [], []) == {} and search(spark, rows, []) == {}
    same(search(spark, [(1, [1.0])], [(2, [-1.0])]), brute({1: [1]}, {2: [-1]}))


def test_traversal_goes_by_summed_distance():
    rng = np.random.default_rng(6)
    one, two = rng.random(9), rng.random(7).round(1)
    cells = list(M.traversal(one, two))
    far = [one[c // 7] + two[c % 7] for c in cells]
    assert sorted(cells) == list(range(63)) and all(a <= b + 1e-15 for a, b in zip(far, far[1:])) and not math.isnan(far[0])


def test_extra_columns_with_clashing_names(spark):
    vectors = clustered(80)
    df = spark.createDataFrame([(i, v, 1, "x", [2], "y") for i, v in vectors.items()], SCHEMA + ", at int, cell string, ids array<int>, part string")
    got = M.nearest_neighbours(df, df.where("vec_id % 10 = 0"), reach=1.0).collect()
    assert len(got) == 40
