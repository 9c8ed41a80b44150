"""Shared by the vector searches: Arrow vectors as matrices, exact products, samples, centres, held parts.

``dealt`` runs a search without shipping an index again for every bunch of queries: the rows of a cell are held by one
task, and whatever is asked of them streams past in batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SEED = 9


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, size = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())
    if (size == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(column)), size), at] = flat
    return out


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 2^53 by whole numbers of any size, held to the range of a long."""
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2**53:
        return q @ v.T
    whole = np.array([[int(x) for x in row] for row in q], object) @ np.array([[int(x) for x in row] for row in v], object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1)


def whole(vector: str) -> Column:
    """The vector is there, and so is each of its components: no null, NaN or infinite one."""
    return F.expr(f"{vector} IS NOT NULL AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")


def sample(rows: DataFrame, size: int) -> pa.Table:
    """vec_id and vector of at most ``size`` rows, the same ones and in the same order in every run."""
    return rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("vec_id", "vector").toArrow()


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of each row of x from each centre."""
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T, 0)


def centres(x: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """``count`` centres of x (fewer if x has fewer rows) by k-means from seeded rows."""
    found = x[np.random.default_rng(SEED).permutation(len(x))[:count]].copy()
    for _ in range(rounds):
        home = nearest(x, found).argmin(1)
        size = np.bincount(home, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, home, x)
        found[size > 0] = sums[size > 0] / size[size > 0, None]
    return found


def dealt(held: DataFrame, passing: DataFrame, cells: int, hold: Callable, scan: Callable, schema: str) -> DataFrame:
    """Answer ``passing`` rows by the ``held`` rows of their cell (an int below ``cells``).

    ``hold`` turns the held rows of a cell (a table) into what ``scan`` needs; ``scan(state, batch)`` yields
    result batches for some of the passing rows. A task keeps one cell's held rows and one batch at a time.
    """
    fields = [*held.columns, *(c for c in passing.columns if c not in held.columns)]
    both = held.withColumn("_kind", F.lit(0)).unionByName(passing.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    both = both.repartitionById(max(1, cells), F.col("cell").cast("int")).sortWithinPartitions("cell", "_kind").select("_kind", *fields)
    own = held.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, state = None, [], None
        for batch in batches:
            kinds, cells_ = batch.column("_kind").to_numpy(), batch.column("cell").to_numpy()
            edges = np.flatnonzero((np.diff(cells_) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
                if a == b:
                    continue
                if cells_[a] != cell:
                    cell, parts, state = cells_[a], [], None
                if kinds[a] == 0:
                    parts.append(batch.slice(a, b - a).select(own))
                elif parts or state is not None:
                    if state is None:
                        state, parts = hold(pa.Table.from_batches(parts).combine_chunks()), []
                    yield from scan(state, batch.slice(a, b - a))

    return both.mapInArrow(run, schema)
