"""Exact top-k inner products by a pivot-distance index.

Inner products become distances by one more coordinate, sqrt(M - |x|^2) with M the largest squared norm
(0 for queries): the nearest vectors then have the highest products. Every vector is keyed by its nearest
pivot and its distance from it; distances are cut into annuli. By the triangle inequality a vector at distance r
from pivot p is at least | |q p| - r | from query q, so a query visits blocks (pivot, annulus) in the order of
that bound and stops when the bound exceeds the distance of its k-th best. Rounds widen the search: a few
blocks, more, then all that the bound leaves.

Pivots and cuts are fitted to a bounded sample (SAMPLE vectors); every vector is indexed, block limits are those of
all vectors, and results are exact. Blocks of many vectors are split, and queries are dealt in chunks of neighbours: runs of
pivots, each next to the one before, that hold QUERIES queries or so (a fuller pivot is split by a hash). In a round a part of a
block goes only to the chunks of which some query visits it, so pruning saves rows shuffled and not just products. A task
holds ROWS vectors and QUERIES queries or so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import stage

SAMPLE, PIVOTS, ANNULI = 4096, 24, 8
ROWS, QUERIES = 4096, 1024
ROUNDS = (4, 24, None)  # blocks visited after each round, nearest first; None: all within the bound
SEED = 9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, size = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())
    if (size == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(column)), size), at] = flat
    return out


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1) + extra * extra
    cross = x @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1]
    return np.sqrt(np.maximum(square[:, None] + (pivots * pivots).sum(1) - 2 * cross, 0))


def fit_pivots(sample: np.ndarray, count: int = PIVOTS, annuli: int = ANNULI) -> tuple[np.ndarray, np.ndarray]:
    """Pivots by a few rounds of k-means on sampled vectors, and the inner cuts of each pivot's distances."""
    rng = np.random.default_rng(SEED)
    pivots = sample[rng.permutation(len(sample))[:count]].copy()
    for _ in range(8):
        d = _distances(sample[:, :-1], sample[:, -1], pivots)
        home = d.argmin(1)
        for p in range(len(pivots)):
            if (home == p).any():
                pivots[p] = sample[home == p].mean(0)
    d = _distances(sample[:, :-1], sample[:, -1], pivots)
    home, near = d.argmin(1), d.min(1)
    steps = np.arange(1, annuli) / annuli
    cuts = np.array([np.quantile(near[home == p], steps) if (home == p).any() else np.quantile(near, steps) for p in range(len(pivots))])
    return pivots, cuts.reshape(len(pivots), annuli - 1)


def chain(pivots: np.ndarray) -> np.ndarray:
    """Pivots in an order that always goes on to the nearest one left."""
    order, left = [0], set(range(1, len(pivots)))
    while left:
        order.append(min(left, key=lambda p: (float(((pivots[p] - pivots[order[-1]]) ** 2).sum()), p)))
        left.remove(order[-1])
    return np.array(order)


def deal(order: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first chunk, number of chunks) of each pivot: runs along ``order`` share a chunk of at most ``size`` queries, a fuller pivot has several."""
    first, number = np.zeros(len(counts), int), np.ones(len(counts), int)
    chunk, held = 0, 0
    for p in order.tolist():
        if held and held + counts[p] > size:
            chunk, held = chunk + 1, 0
        first[p], number[p] = chunk, max(1, -(-int(counts[p]) // size))
        held += int(counts[p])
        if held > size:
            chunk, held = chunk + int(number[p]), 0
    return first, number


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row, ties to the lower column."""
    n = scores.shape[1]
    if k < n and np.abs(scores[np.isfinite(scores)]).max(initial=0) * n < 2**52:
        keys = scores * n - np.arange(n)  # distinct and exact
        top = np.argpartition(-keys, k - 1, axis=1)[:, :k]
        return np.take_along_axis(top, np.argsort(-np.take_along_axis(keys, top, 1), axis=1), 1)
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 2^53 by whole numbers of any size, held to the range of a long."""
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2**53:
        return q @ v.T
    whole = np.array([[int(x) for x in row] for row in q], object) @ np.array([[int(x) for x in row] for row in v], object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1)


def _scan(width: int, k: int):
    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        query, found, score = [], [], []
        if len(left) and len(right):
            order = np.argsort(right["vec_id"].to_numpy(), kind="stable")
            ids, v = right["vec_id"].to_numpy()[order], _matrix(right["vector"], width)[order]
            q, q_ids = _matrix(left["vector"], width), left["query_id"].to_numpy()
            for a in range(0, len(q), QUERIES):
                exact = _products(q[a : a + QUERIES], v)
                s = exact.astype(float)
                own = q_ids[a : a + QUERIES, None] == ids
                s[own] = -np.inf
                if exact.dtype == object:
                    top = np.array([sorted(range(len(ids)), key=lambda j: (bool(o[j]), -e[j], ids[j]))[:k] for e, o in zip(exact, own)])
                else:
                    top = _best(s, k)
                keep = ~np.take_along_axis(own, top, 1)
                query.append(np.repeat(q_ids[a : a + QUERIES], keep.sum(1)))
                found.append(ids[top][keep])
                score.append(np.take_along_axis(exact, top, 1)[keep].astype(np.int64))
        join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        return pa.table({"query_id": join(query), "vec_id": join(found), "score": join(score)})

    return of


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of rows whose vector is whole: no null, NaN or infinite component.

    A repeated vec_id counts once, with its largest vector. Rows without vec_id take no part.
    """
    whole = F.expr("vec_id IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).where(whole)
    return rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def shipped(index: DataFrame, visited: DataFrame) -> DataFrame:
    """The rows of the index once for every chunk of queries that visits their part of a block."""
    rows = index.select("vec_id", "vector", "block", "part")
    return rows.join(visited.distinct(), ["block", "part"]).select("vec_id", "vector", "block", "part", "chunk")


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k highest inner products of each query with all vectors but its own, exactly.

    ``vectors`` and ``queries`` have vec_id and vector, of whole numbers. Returns query_id, rank, vec_id, score;
    ties go to the smaller vec_id, and fewer rows come if there are fewer vectors. Vectors of unequal length are
    compared as if filled with zeros. Unusable vectors (see ``usable``) take no part, on either side.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors), "vectors")
    asked = stage(usable(queries), "queries")
    norm = "aggregate(vector, 0D, (a, x) -> a + x * x)"
    width, most, n, n_asked = (*rows.agg(F.max(F.size("vector")), F.max(F.expr(norm)), F.count("*")).first(), asked.count())
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not n or not n_asked:
        return empty
    width = max(width, asked.agg(F.max(F.size("vector"))).first()[0], 1)
    rate = min(1.0, SAMPLE / n)
    picked = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) <= int(rate * 1_000_003)).select("vector").toArrow()  # about SAMPLE rows

    def extra(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(most - (x * x).sum(1), 0))

    sample = _matrix(picked["vector"], width)
    if not len(sample):
        sample = np.zeros((1, width))
    pivots, cuts = fit_pivots(np.column_stack((sample, extra(sample))))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            d = _distances(x, extra(x), pivots)
            home, near = d.argmin(1), d.min(1)
            ring = (near[:, None] > cuts[home]).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((home * ANNULI + ring).astype(np.int32)), pa.array(near)],
                                             ["vec_id", "vector", "block", "distance"])

    index = stage(rows.mapInArrow(keyed, "vec_id bigint, vector array<double>, block int, distance double"), "index")
    blocks = index.groupBy("block").agg(F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).collect()  # PIVOTS * ANNULI rows at most
    number = np.array([b["block"] for b in blocks])
    low, high = np.array([b["low"] for b in blocks]), np.array([b["high"] for b in blocks])
    splits = np.array([-(-b["n"] // ROWS) for b in blocks])

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column(1), width)
            home = _distances(q, np.zeros(len(q)), pivots).argmin(1) if len(q) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32))], ["vec_id", "vector", "home"])

    asked = stage(asked.mapInArrow(homes, "vec_id bigint, vector array<double>, home int"), "homes")
    counts = np.zeros(len(pivots), int)
    for row in asked.groupBy("home").count().collect():  # PIVOTS rows at most
        counts[row["home"]] = row["count"]
    first, number_of = deal(chain(pivots), counts, QUERIES)
    of_home = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("home") + 1)
    asked = asked.withColumn("chunk", (of_home(first) + F.pmod(F.hash("vec_id"), of_home(number_of))).cast("int")).drop("home")
    parts = F.element_at(F.create_map(*[F.lit(int(x)) for pair in zip(number, splits) for x in pair]), F.col("block"))
    index = index.withColumn("part", F.pmod(F.hash("vec_id"), parts).cast("int"))

    def visits(done: int, upto: int | None):
        """Blocks of each query between two rounds, a row for each part of a block."""
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, len(batch), 1024):
                    some = batch.slice(a, 1024)
                    q = _matrix(some.column(1), width)
                    d = _distances(q, np.zeros(len(q)), pivots)[:, number // ANNULI]
                    bound = np.maximum(0, np.maximum(d - high, low - d))
                    reach = some.column(2).to_numpy(zero_copy_only=False)
                    order = np.argsort(bound, axis=1, kind="stable")
                    place = np.argsort(order, axis=1, kind="stable")
                    go = (place >= done) & (bound * (1 - 1e-9) - 1e-6 <= reach[:, None])
                    if upto is not None:
                        go &= place < upto
                    row, block = np.nonzero(go)
                    row, block = np.repeat(row, splits[block]), np.repeat(block, splits[block])
                    fresh = np.concatenate(([True], (row[1:] != row[:-1]) | (block[1:] != block[:-1]))) if len(row) else np.zeros(0, bool)
                    part = np.arange(len(row)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(row) else row
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row)), pa.array(number[block].astype(np.int32)), pa.array(part.astype(np.int32)),
                         some.column(3).take(pa.array(row))],
                        ["query_id", "vector", "block", "part", "chunk"])

        return of

    def cells(done: int, upto: int | None):
        """The (block, part, chunk) that some query of a batch visits, once each."""
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in visits(done, upto)(batches):
                at = np.unique(np.stack([np.asarray(batch.column(c)) for c in (2, 3, 4)], 1).reshape(-1, 3), axis=0).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at[:, c]) for c in range(3)], ["block", "part", "chunk"])

        return of

    best = None
    cell = ["block", "part", "chunk"]
    by_rank = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    done = 0
    for upto in ROUNDS:
        if best is None:
            todo = asked.select(F.col("vec_id").alias("query_id"), "vector", F.lit(float("inf")).alias("reach"), "chunk")
        else:
            worst = best.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("held"))
            todo = asked.withColumnRenamed("vec_id", "query_id").join(worst, "query_id", "left")
            reach = F.sqrt(F.greatest(F.expr(norm) + F.lit(most) - 2 * F.col("score"), F.lit(0.0)))
            todo = todo.select("query_id", "vector", F.when(F.col("held") >= k, reach).otherwise(float("inf")).alias("reach"), "chunk")
        go = todo.mapInArrow(visits(done, upto), "query_id bigint, vector array<double>, block int, part int, chunk int")
        wide = shipped(index, todo.mapInArrow(cells(done, upto), "block int, part int, chunk int"))
        found = go.groupBy(*cell).cogroup(wide.groupBy(*cell)).applyInArrow(_scan(width, k), "query_id bigint, vec_id bigint, score bigint")
        if best is not None:
            found = found.unionByName(best)
        best = stage(found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k).drop("rank"), "best")
        done = upto
    return best.select("query_id", F.row_number().over(by_rank).alias("rank"), "vec_id", "score")
