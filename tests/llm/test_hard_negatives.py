import random

import numpy as np
import pytest

from tidemark.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label int, vector array<double>"


def brute(rows, anchors, positives=5, negatives=10, least=30, most=90):
    width = max((len(v) for _, v in rows.values()), default=0)
    full = {i: (label, [int(x) for x in v] + [0] * (width - len(v))) for i, (label, v) in rows.items()}
    out = []
    for a in sorted(set(anchors) & set(full)):
        score = {i: sum(x * y for x, y in zip(full[a][1], v)) for i, (_, v) in full.items()}
        order = sorted(full, key=lambda i: (-score[i], i))
        good = [i for i in order if full[i][0] == full[a][0] and i != a][:positives]
        bad = [i for i in order if full[i][0] != full[a][0]]
        for p in good:
            inside = [i for i in bad if least * score[p] <= 100 * score[i] <= most * score[p]][:negatives]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, anchors, **options):
    df = spark.createDataFrame([(i, *r) for i, r in rows.items()] if isinstance(rows, dict) else rows, SCHEMA)
    return sorted(map(tuple, H.hard_negatives(df, spark.createDataFrame([(a,) for a in anchors], "vec_id bigint"), **options).collect()))


def clustered(n, seed=3, labels=4, width=6):
    rng = random.Random(seed)
    middles = [[rng.randint(-60, 60) for _ in range(width)] for _ in range(5)]
    rows = {i: (rng.randrange(labels), [float(m + rng.randint(-6, 6)) for m in middles[i % 5]]) for i in range(n)}
    return rows | {n + i: (i % 2, [9.0, 1.0, 0.0, 0.0, 2.0, -1.0]) for i in range(n // 3)}  # one vector many times


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force_with_ties_and_hot_vectors(spark, monkeypatch, small):
    if small:  # several blocks and parts, groups and copies of parts
        for name, value in (("ROWS", 16), ("GROUP", 4), ("SLAB", 2), ("CENTRES", 7), ("SAMPLE", 64)):
            monkeypatch.setattr(H, name, value)
    rows = clustered(300)
    anchors = [i for i in rows if i % 11 == 0]
    assert mined(spark, rows, anchors) == brute(rows, anchors)
    options = {"positives": 2, "negatives": 3, "least": 50, "most": 100}
    assert mined(spark, rows, anchors, **options) == brute(rows, anchors, **options)


@pytest.mark.parametrize("rounds", [(None,), (1, None), (1, 3, None)])
def test_rounds_do_not_change_the_result(spark, monkeypatch, rounds):
    monkeypatch.setattr(H, "ROUNDS", rounds)
    monkeypatch.setattr(H, "ROWS", 24)
    rows = clustered(240, seed=8)
    anchors = [i for i in rows if i % 9 == 0]
    assert mined(spark, rows, anchors) == brute(rows, anchors)


def test_unusable_rows_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [1.0, 2.0]), (2, 0, None), (3, 0, [1.0, None]), (4, 1, [nan, 1.0]), (5, 1, [inf, 1.0]), (None, 1, [9.0, 9.0]), (6, None, [9.0, 9.0]),
            (7, 0, [10.0, 20.0]), (8, 1, [3.0, 3.0]), (8, 1, [3.0, 3.0]), (9, 1, []), (10, 2, [8.0])]
    whole = {1: (0, [1, 2]), 7: (0, [10, 20]), 8: (1, [3, 3]), 9: (1, []), 10: (2, [8])}
    ids = [r[0] for r in rows]
    assert mined(spark, rows, ids) == brute(whole, whole)
    assert mined(spark, [(1, 0, [1.0])], [1]) == [] and mined(spark, [], [1]) == [] and mined(spark, rows, []) == []
    assert mined(spark, rows, [3, 77]) == []  # no anchor is a usable row


def test_products_beyond_doubles_stay_exact(spark):
    rows = {i: (i % 2, [2.0**30 + i, float(i), 2.0**28]) for i in range(30)}
    assert mined(spark, rows, [0, 7], least=0, most=100) == brute(rows, [0, 7], least=0, most=100)


def test_negative_positives_have_no_window(spark):
    rows = {1: (0, [1.0]), 2: (0, [-5.0]), 3: (1, [-3.0]), 4: (1, [-2.0])}
    assert mined(spark, rows, [1]) == brute(rows, [1]) == []


def test_tree_has_parents_first_and_true_edges():
    x = np.random.default_rng(2).normal(size=(40, 5))
    order, parents, edges = H.spanning_tree(x)
    assert sorted(order) == list(range(40)) and parents[0] == -1 and all(p < i for i, p in enumerate(parents))
    assert all(abs(e - np.linalg.norm(x[o] - x[order[p]])) < 1e-6 for o, p, e in list(zip(order, parents, edges))[1:])


def test_bounds_spare_rescoring(monkeypatch):
    """Rows far outside a child's windows are not scored again."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 1, (500, 8)) for m in (-100, 100)]).round()
    ids, labels = np.arange(1000), np.arange(1000) % 2
    part = (ids, labels, x, np.sqrt((x * x).sum(1)))
    nodes = [(5000, 0, -1, 0.0, x[600]), (5001, 0, 0, float(np.linalg.norm(x[601] - x[600])), x[601])]
    scored, real = [], H.products
    monkeypatch.setattr(H, "products", lambda q, v: scored.append(len(v)) or real(q, v))
    list(H.windows_in_part(part, nodes, {a: [(1, *H.ENDS)] for a in (5000, 5001)}, True, 5))
    assert scored[0] == 1000 and scored[1] <= 260  # of the label, in the near half


def test_extra_columns_with_clashing_names(spark):
    rows = clustered(60)
    df = spark.createDataFrame([(i, *r, 1, "x", 2, 0.5) for i, r in rows.items()], SCHEMA + ", block int, `group` string, part int, far double")
    got = H.hard_negatives(df, df.where("vec_id % 20 = 0"))
    assert sorted(map(tuple, got.collect())) == brute(rows, [i for i in rows if i % 20 == 0])
