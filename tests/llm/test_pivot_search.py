import random

import pytest

from tidemark.llm import pivot_search as P

SCHEMA = "vec_id bigint, vector array<double>"


def brute(vectors, queries, k=5):
    out = {}
    for q, x in queries.items():
        width = max(map(len, [*vectors.values(), *queries.values()]), default=0)
        full = lambda v: list(v) + [0] * (width - len(v))
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(full(x), full(v))), i) for i, v in vectors.items() if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def search(spark, rows, queries, k=5):
    got = P.top_products(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(queries, SCHEMA), k).orderBy("query_id", "rank").collect()
    out = {}
    for r in got:
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force_with_ties_and_hot_vectors(spark, monkeypatch, small):
    if small:  # blocks are split, queries dealt in chunks
        monkeypatch.setattr(P, "ROWS", 16)
        monkeypatch.setattr(P, "QUERIES", 7)
    rng = random.Random(3)
    vectors = {i: [float(rng.randint(-9, 9)) for _ in range(6)] for i in range(300)}
    vectors |= {300 + i: [3.0, 1.0, 0.0, 0.0, 2.0, -1.0] for i in range(120)}  # one vector many times
    queries = {i: v for i, v in vectors.items() if i % 20 == 0}
    assert search(spark, list(vectors.items()), list(queries.items())) == brute(vectors, queries)


def test_pruning_leaves_out_blocks_of_clustered_vectors():
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.1, (200, 4)) for c in (0, 50, 100)])
    pivots, cuts = P.fit_pivots(np.column_stack((x, np.zeros(len(x)))), 3, 4)
    d = P._distances(x, np.zeros(len(x)), pivots)
    assert cuts.shape == (3, 3) and (d.min(1) < 2).all() and (np.sort(d, 1)[:, 1] > 40).all()


def test_unusable_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [9.0, 9.0]), (6, [2.0, 2.0]), (6, [2.0, 2.0]), (7, []), (8, [5.0])]
    whole = {1: [1, 2], 6: [2, 2], 7: [], 8: [5]}
    assert search(spark, rows, rows) == brute(whole, whole)
    assert search(spark, [(1, [1.0])], [(1, [1.0])]) == {}
    assert search(spark, [], []) == {} and search(spark, rows, []) == {}


def test_large_components_stay_exact(spark):
    rows = {1: [2.0**40, 1.0], 2: [2.0**20, 1.0], 3: [2.0**20, 0.0], 4: [-(2.0**20), 3.0]}
    assert search(spark, list(rows.items()), list(rows.items())) == brute(rows, rows)


def test_chunks_hold_neighbouring_pivots():
    import numpy as np

    pivots = np.array([[0.0, 0], [50.0, 0], [1.0, 0], [51.0, 0], [2.0, 0]])
    order = P.chain(pivots)
    assert order.tolist() == [0, 2, 4, 1, 3]
    counts = np.array([3, 2, 3, 25, 4])
    first, number = P.deal(order, counts, 10)
    assert first.tolist() == [0, 1, 0, 2, 0] and number.tolist() == [1, 1, 1, 3, 1]
    rng = random.Random(8)
    for _ in range(200):
        counts = np.array([rng.choice([0, 1, 5, 10, 11, 40]) for _ in pivots])
        first, number = P.deal(order, counts, 10)
        held = {}
        for p, n in enumerate(counts.tolist()):
            for c in range(number[p]):
                held.setdefault(int(first[p]) + c, []).append(n / number[p])
        assert all(sum(x) <= 10 for x in held.values())
        assert sum(map(sum, held.values())) == pytest.approx(counts.sum())


def test_index_rows_go_only_where_queries_visit(spark, monkeypatch):
    """Ten clusters, ten chunks of queries: a row is sent to far fewer chunks than there are."""
    monkeypatch.setattr(P, "QUERIES", 40)
    monkeypatch.setattr(P, "ROWS", 64)
    rng = random.Random(4)
    centres = [[1000.0 * (c == d) for d in range(10)] for c in range(10)]
    vectors = {i: [x + rng.randint(-3, 3) for x in centres[i % 10]] for i in range(2000)}
    queries = {i: v for i, v in vectors.items() if i // 10 % 5 == 0}
    sent, real = [], P.shipped

    def counted(index, visited):
        rows = real(index, visited)
        sent.append(rows.count())
        return rows

    monkeypatch.setattr(P, "shipped", counted)
    assert search(spark, list(vectors.items()), list(queries.items())) == brute(vectors, queries)
    assert len(queries) == 400 and sum(sent) < 0.5 * len(P.ROUNDS) * 10 * len(vectors)


def test_further_columns_of_clashing_names(spark):
    rows = [(i, [float(i % 5), 1.0], "x", "y", "z", 7) for i in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA + ", block string, chunk string, score string, query_id int")
    got = P.top_products(frame, frame.where("vec_id < 3")).collect()
    assert len(got) == 15
