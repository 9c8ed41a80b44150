"""Approximate nearest neighbours by cosine with an inverted multi-index.

Vectors are scaled to length 1 and cut into two halves, each half quantised by its own centroids; a vector's cell is the
pair of its halves' nearest centroids. A query goes through the pairs in the order of their summed distances, by a heap, until
the cells it has met hold ``reach`` of all entries, and the entries of those cells are ranked by their exact cosine.

The index is fitted on a bounded sample (SAMPLE vectors): one half of it gives the centroids, whose number grows with the
fourth root of the table, and the other half the reach, the share of entries within which ``target`` of the true
neighbours of held-out vectors lie, plus a margin for their small number. Every vector is indexed. Entries are
distinct vectors with the smallest ids that hold them, so copies of one vector, however many, are one entry. Entries of
a row of cells are split into parts of at most about ROWS, which stay where they are while the queries pass.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import stage
from .vectors import centres, dealt, matrix, nearest, sample, whole

SAMPLE, CENTROIDS = 8192, 128  # at most
TARGET = 0.96
ROWS, QUERIES = 4096, 1 << 16  # entries of a part; queries that pass one copy of it
BUNCH = 256  # queries scored at once
SLACK = 1e-12  # what rounding may add to a cosine


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by a power of two so that no square overflows."""
    x = x * np.exp2(-np.frexp(np.abs(x).max(1, initial=0))[1].astype(float))[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of each row of q and the same row of v, in one order of additions whatever the batch."""
    q, v = (x * np.exp2(-np.frexp(np.abs(x).max(1, initial=0))[1].astype(float))[:, None] for x in (q, v))
    return np.einsum("ij,ij->i", q, v) / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", v, v)))


class Quantiser:
    """Centroids of the two halves."""

    def __init__(self, x: np.ndarray, count: int):
        self.cut = -(-x.shape[1] // 2)
        self.first, self.second = centres(x[:, : self.cut], count), centres(x[:, self.cut :], count)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, : self.cut], self.first), nearest(x[:, self.cut :], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        one, two = self.distances(x)
        return one.argmin(1) * len(self.second) + two.argmin(1)


def traversal(one: np.ndarray, two: np.ndarray) -> Iterator[int]:
    """Cells in the order of their summed distances: a heap of the next pair in each begun row."""
    rows, columns = np.argsort(one, kind="stable").tolist(), np.argsort(two, kind="stable").tolist()
    x, y = np.sort(one).tolist(), np.sort(two).tolist()
    width, heap = len(y), [(x[0] + y[0], 0, 0)]
    while heap:
        _, i, j = heap[0]
        yield rows[i] * width + columns[j]
        if j + 1 < width:
            heapq.heapreplace(heap, (x[i] + y[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def fitted_reach(quantiser: Quantiser, x: np.ndarray, k: int, target: float) -> float:
    """Share of entries that a query has to meet, from held-out vectors x among themselves."""
    n = min(512, len(x))
    if n <= k:
        return 1.0
    one, two = quantiser.distances(x)
    home, other = one.argmin(1), two.argmin(1)
    score = x[:n] @ x.T
    score[np.arange(n), np.arange(n)] = -np.inf
    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
    far = one[:n][:, home] + two[:n][:, other]  # of each vector's cell from the query
    share = (far[:, None, :] <= np.take_along_axis(far, top, 1)[:, :, None]).mean(2) if n * k * len(x) < 1 << 24 else np.stack(
        [(far[i] <= far[i, top[i], None]).mean(1) for i in range(n)])
    return min(1.0, float(np.quantile(share, target)) + 0.5 / math.sqrt(n))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of rows whose vector is whole and not zero; a repeated vec_id counts once, with
    its largest vector. Rows without vec_id take no part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & whole("vector") & F.expr("exists(vector, x -> x <> 0)"))
    return rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, target: float = TARGET, reach: float | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` nearest vectors found for each query, its own vec_id left out.

    ``vectors`` and ``queries`` have vec_id and vector. score is the cosine of the original vectors in double precision;
    the highest come first, ties go to the smaller vec_id, and all vectors come if there are no more than ``k``. ``target`` is
    the recall to fit for; ``reach`` (0 to 1) sets the share of entries by hand, 1 makes the search exact. Vectors of unequal
    length count as filled with zeros; null, zero, empty and not wholly finite ones take no part, on either side (``usable``).
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    kept = usable(vectors)
    copy = W.partitionBy("vector").orderBy("vec_id")
    few = kept.withColumn("_copy", F.row_number().over(copy)).where(F.col("_copy") <= k + 1)
    entries = stage(few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries")
    asked = stage(usable(queries), "queries")
    (n, width), (n_asked, asked_width) = (df.agg(F.count("*"), F.max(F.size("vector"))).first() for df in (entries, asked))
    if not n or not n_asked:
        return empty
    width = max(width, asked_width)
    picked = unit(matrix(sample(entries.select(F.col("ids")[0].alias("vec_id"), "vector"), SAMPLE)["vector"], width))
    count = max(2, min(CENTROIDS, round(4 * n**0.25)))
    quantiser = Quantiser(picked[::2], count)
    if reach is None:
        reach = fitted_reach(quantiser, picked[1::2], k, target)
    across = len(quantiser.second)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = quantiser.cells(unit(matrix(batch.column(0), width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], ["vector", "ids", "at"])

    index = stage(entries.mapInArrow(placed, "vector array<double>, ids array<bigint>, at int"), "multi-index")
    held = {r["at"]: r["n"] for r in index.groupBy("at").agg(F.count("*").alias("n")).collect()}  # CENTROIDS^2 rows at most
    sizes = np.zeros(len(quantiser.first) * across, np.int64)
    sizes[list(held)] = list(held.values())

    # neighbouring rows of cells share a part, a row of many entries is split into several
    rows = min(ROWS, -(-n // spark.sparkContext.defaultParallelism))
    per_row = sizes.reshape(-1, across).sum(1)
    part_of, splits, filled = np.zeros(len(per_row), np.int64), [], 0
    for i, size in enumerate(per_row.tolist()):
        if not splits or filled + size > rows:
            splits.append(max(1, -(-size // rows)))
            filled = 0
        part_of[i] = len(splits) - 1
        filled += size
    first = np.concatenate(([0], np.cumsum(splits)))
    slabs = -(-n_asked // QUERIES)
    want = max(math.ceil(reach * n), k + 1)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch.column(1), width))
            one, two = quantiser.distances(x)
            for a in range(0, len(batch), BUNCH):
                row, part, lists = [], [], []
                for q in range(a, min(a + BUNCH, len(batch))):
                    met, cells = 0, []
                    for cell in traversal(one[q], two[q]):
                        if sizes[cell]:
                            cells.append(cell)
                            met += sizes[cell]
                            if met >= want:
                                break
                    cells = np.sort(np.array(cells, np.int64))
                    home = part_of[cells // across]
                    edges = np.flatnonzero(np.diff(home)) + 1
                    for some, p in zip(np.split(cells, edges), home[np.concatenate(([0], edges))].tolist()):
                        for s in range(splits[p]):
                            row.append(q)
                            part.append(first[p] + s)
                            lists.append(some)
                ends = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).astype(np.int32)))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), cells, pa.array(np.array(part, np.int32))],
                                                 ["query_id", "vector", "cells", "part"])

    def hold(table: pa.Table) -> tuple:
        order = np.argsort(table["at"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        at = table["at"].to_numpy()
        own, begin = np.unique(at, return_index=True)
        x = matrix(table["vector"], width)
        return own, np.append(begin, len(at)), x, unit(x), table["ids"].combine_chunks()

    def scan(state: tuple, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, begin, x, scaled, ids = state
        lists, ends, least = ids.flatten().to_numpy(), ids.offsets.to_numpy(), ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1]]
        for a in range(0, len(batch), BUNCH):
            some = batch.slice(a, BUNCH)
            q_ids, q = some.column("query_id").to_numpy(), matrix(some.column("vector"), width)
            cells = some.column("cells")
            asker, cell = np.repeat(np.arange(len(some)), np.asarray(cells.value_lengths())), cells.flatten().to_numpy()
            place = np.searchsorted(own, cell)
            here = (place < len(own)) & (own[np.minimum(place, len(own) - 1)] == cell)  # a split may hold no entry of a cell
            asker, place = asker[here], place[here]
            order = np.argsort(place, kind="stable")
            asker, place = asker[order], place[order]
            score = np.full((len(some), len(x)), -np.inf)
            scaled_q = unit(q)
            for group in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place)) + 1):
                if len(group):
                    c, who = place[group[0]], asker[group]
                    score[who, begin[c] : begin[c + 1]] = scaled_q[who] @ scaled[begin[c] : begin[c + 1]].T
            keep = min(k + 1, len(x))
            limit = -np.partition(-score, keep - 1, axis=1)[:, keep - 1] - SLACK
            query, found, result = [], [], []
            for i in range(len(some)):
                near = np.flatnonzero((score[i] >= limit[i]) & (score[i] > -np.inf))
                exact = cosines(np.broadcast_to(q[i], (len(near), width)), x[near])
                best = np.lexsort((least[near], -exact))[: k + 1]
                held_ids = [lists[ends[e] : ends[e + 1]] for e in near[best].tolist()]
                flat = np.concatenate(held_ids) if held_ids else np.zeros(0, np.int64)
                scores = np.repeat(exact[best], [len(h) for h in held_ids])
                other = flat != q_ids[i]
                flat, scores = flat[other], scores[other]
                top = np.lexsort((flat, -scores))[:k]
                query += [q_ids[i]] * len(top)
                found.append(flat[top])
                result.append(scores[top])
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(np.concatenate(found)), pa.array(np.concatenate(result))],
                                             ["query_id", "vec_id", "score"])

    parts = int(first[-1])
    lay = F.array(*[F.struct(F.lit(int(first[p])).alias("a"), F.lit(int(splits[p])).alias("s")) for p in part_of.tolist()])[F.expr(f"at div {across}")]
    part = index.withColumn("_lay", lay).select("vector", "ids", "at", (F.col("_lay.a") + F.pmod(F.xxhash64("vector"), F.col("_lay.s"))).cast("int").alias("part"))
    dealt_parts = part.select("vector", "ids", "at", F.explode(F.sequence(F.col("part"), F.col("part") + (slabs - 1) * parts, F.lit(parts))).alias("cell"))
    go = asked.select(F.col("vec_id").alias("query_id"), "vector").mapInArrow(visits, "query_id bigint, vector array<double>, cells array<int>, part int")
    slab = F.pmod(F.xxhash64("query_id"), F.lit(slabs)) * parts
    go = go.select("query_id", "vector", "cells", (F.col("part") + slab).cast("int").alias("cell"))
    found = dealt(dealt_parts, go, parts * slabs, hold, scan, "query_id bigint, vec_id bigint, score double")
    by_rank = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
