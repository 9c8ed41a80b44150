"""Near-duplicate groups by MinHash bands and odd sketches.

Every document gets ``rows * bands`` MinHash samples of its distinct word shingles. Bands of samples
find candidates; an odd sketch (each sample toggles one bit of a bitmap) tells from the population
count of an XOR which candidates cannot be similar; the rest are confirmed on their full sets.

Losses: a pair at the threshold 0.75 shares no band with probability (1 - 0.75^4)^40 = 2.4e-7, and the
sketch limit lies SPREAD standard deviations beyond what such a pair shows. More similar pairs are
lost far more rarely.

Groups of copies of any size: rows with equal sets become one representative. In a band bucket all
members are first compared with its smallest member only. What that links is one component; then
only members outside that component are compared with the bucket, block by block, inside tasks, and
only links leave the task. No list of all pairs of a group is made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, stage
from .words import U, mix, shingle_sets

ROWS, BANDS, BITS, SPREAD = 4, 40, 1024, 5.5
PROBES, BASES = 256, 1024  # members of a bucket compared in one task
_rng = np.random.default_rng(7)
_A = _rng.integers(0, 1 << 31, ROWS * BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint32)


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples (a row for each non-empty set): smallest of a x + b over 32 bits of the shingles."""
    flat = (np.concatenate(sets) >> U(32)).astype(np.uint32)
    first = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), len(_A)), np.uint32)
    for k in range(len(_A)):
        out[:, k] = np.minimum.reduceat(flat * _A[k] + _B[k], first)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of samples; the band's number is part of it."""
    keys = np.broadcast_to(np.arange(BANDS, dtype=U) + U(1), (len(found), BANDS)).copy()
    for r in range(ROWS):
        keys = mix(keys + found[:, r::ROWS].astype(U))
    return keys


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """Bitmaps of BITS bits as 64-bit words: bit = parity of the samples that hash to it."""
    n, k = found.shape
    bit = (mix(found.astype(U) + (np.arange(k, dtype=U) << U(32))) >> U(20)) % U(BITS)
    at = bit.astype(np.int64) + np.arange(n)[:, None] * BITS
    odd = (np.bincount(at.ravel(), minlength=n * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, BITS), axis=1).view(U)


def sketch_limit(percent: int) -> int:
    """Largest XOR population count that a pair at the threshold is expected to show."""
    k, miss = ROWS * BANDS, 1 - percent / 100
    m = k * miss
    mean = BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * m))
    slope = -BITS * math.log(1 - 2 / BITS) * (1 - 2 / BITS) ** (2 * m)
    by_samples, by_bits = slope * math.sqrt(k * miss * (1 - miss)), 2 * math.sqrt(2 * m * m / BITS)
    return math.ceil(mean + SPREAD * math.hypot(by_samples, by_bits))


def _longs(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    flat = pa.array(np.ascontiguousarray(rows).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), flat)


def _signatures(size: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in shingle_sets(batch.column(1), size):
                ids = batch.column(0).slice(at, len(sets))
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                prints = np.array([[mix(s ^ U(1)).sum(dtype=U), mix(s ^ U(2)).sum(dtype=U)] for s in sets], U).reshape(-1, 2)
                prints = prints.view(np.int64)
                none = pa.array([None] * len(sets), pa.list_(pa.int64()))
                bands = sketch = none
                if len(full):
                    found = samples([sets[i] for i in full])
                    where = np.full(len(sets), -1)
                    where[full] = np.arange(len(full))
                    pick = pa.array(where, mask=where < 0)
                    bands, sketch = _longs(band_keys(found)).take(pick), _longs(odd_sketches(found)).take(pick)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]), bands, sketch],
                    ["doc_id", "n_shingles", "print1", "print2", "bands", "sketch"])

    return of


SIGNATURE = "doc_id bigint, n_shingles bigint, print1 bigint, print2 bigint, bands array<bigint>, sketch array<bigint>"


def _confirm(size: int, percent: int):
    """Keep pairs whose full sets overlap enough."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            left, right = shingle_sets(batch.column(2), size), shingle_sets(batch.column(3), size)
            a_sets, b_sets, a_at, b_at = [], [], 0, 0
            for row in range(len(batch)):
                if row == a_at + len(a_sets):
                    a_at, a_sets = next(left)
                if row == b_at + len(b_sets):
                    b_at, b_sets = next(right)
                keep[row] = _similar(a_sets[row - a_at], b_sets[row - b_at], percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return of


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if percent * max(len(x), len(y)) > 100 * min(len(x), len(y)) or not len(x):
        return False
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _block_links(size: int, percent: int):
    """Links of one block: its probes against its bases, in the first band that a pair shares."""
    limit = sketch_limit(percent)

    def of(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        ids, comp = block["rep"].to_numpy(), block["component"].to_numpy()
        probe, base = (block[c].to_numpy(zero_copy_only=False) for c in ("probe", "base"))
        key = block["key"][0].as_py()
        sets = [s for _, part in shingle_sets(block["text"].chunk(0), size) for s in part]
        found = samples(sets)
        bands, sketch = band_keys(found), odd_sketches(found)
        here = int(np.flatnonzero(bands[0].view(np.int64) == key)[0])
        low, high = [], []
        others = np.flatnonzero(base)
        for i in np.flatnonzero(probe):
            # of two probes, the later one meets the earlier
            near = others[(comp[others] != comp[i]) & (~probe[others] | (ids[others] < ids[i]))]
            near = near[np.bitwise_count(sketch[near] ^ sketch[i]).sum(axis=1) <= limit]
            near = near[~(bands[near, :here] == bands[i, :here]).any(axis=1)]
            for j in near:
                if _similar(sets[i], sets[j], percent):
                    low.append(ids[i])
                    high.append(ids[j])
        return pa.table({"a": pa.array(low, pa.int64()), "b": pa.array(high, pa.int64())})

    return of


def _far(limit: int, left: str, right: str):
    """XOR population count of two sketches, as SQL without a loop."""
    bits = " + ".join(f"bit_count({left}[{i}] ^ {right}[{i}])" for i in range(BITS // 64))
    return f"({bits}) <= {limit}"


def near_groups(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """Groups of documents (doc_id, text) linked by shingle sets of similarity ``percent`` or more.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept, a row for
    each input row. Null, empty and blank texts have no shingles and no links. Rows with the same text
    are linked. Rows of one doc_id count as one document in links; each keeps the group of its own text.
    A row without doc_id is linked with nothing, has no component and is kept. Further columns drop.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stage(docs.mapInArrow(_signatures(size), SIGNATURE), "signatures")
    prints = ["print1", "print2", "n_shingles"]
    least = F.min(F.struct(F.col("doc_id").alias("rep"), "bands", "sketch")).alias("r")
    reps = signed.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy(*prints).agg(least)
    reps = stage(reps.select(*prints, "r.*"), "representatives")
    members = reps.select("rep", F.explode("bands").alias("key"))

    # each bucket's members against its smallest
    buckets = members.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last"))
    buckets = buckets.where("center < last")
    shared = stage(members.join(buckets.select("key", "center"), "key"), "buckets")
    stars = shared.where("rep <> center").select("center", "rep").distinct()
    sketches = reps.select("rep", "sketch")
    limit = sketch_limit(percent)
    pairs = (
        stars.join(sketches, "rep")
        .join(sketches.select(F.col("rep").alias("center"), F.col("sketch").alias("other")), "center")
        .where(F.expr(_far(limit, "sketch", "other"))).select(F.col("center").alias("a"), F.col("rep").alias("b"))
    )
    texts = stage(docs.join(shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "texts")
    pairs = stage(pairs, "pairs")
    pairs = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    links = stage(pairs.mapInArrow(_confirm(size, percent), "a bigint, b bigint"), "links")
    labels = components(links, "stars")

    # what is left: members of a bucket outside the component of its smallest
    named = shared.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = named.join(labels.select(F.col("node").alias("center"), F.col("component").alias("major")), "center", "left").withColumn(
        "probe", F.col("component") != F.coalesce("major", "center"))
    named = stage(named.select("key", "rep", "component", "probe"), "named")
    counts = named.groupBy("key").agg(F.count("*").alias("n"), F.count_if("probe").alias("n_probe")).where("n_probe > 0 AND n > 2")
    open_ = named.join(counts, "key").join(sketches, "rep")
    left, right = open_.alias("x"), open_.alias("y")
    near = F.expr(f"x.key = y.key AND x.component <> y.component AND (x.probe OR y.probe) AND {_far(limit, 'x.sketch', 'y.sketch')}")
    active = stage(left.join(right, near, "left_semi").drop("sketch", "n", "n_probe"), "active")
    counts = active.groupBy("key").agg(F.ceil(F.count("*") / BASES).alias("n_base"), F.ceil(F.count_if("probe") / PROBES).alias("n_probe"))
    placed = active.join(counts.where("n_probe > 0"), "key").withColumns(
        {"at_base": F.pmod(F.hash("rep"), F.col("n_base")), "at_probe": F.pmod(F.hash("rep"), F.col("n_probe"))})
    cells = F.expr("""array_distinct(concat(
        transform(sequence(0, n_probe - 1), p -> named_struct('p', p, 'b', at_base)),
        IF(probe, transform(sequence(0, n_base - 1), b -> named_struct('p', at_probe, 'b', b)), array())))""")
    placed = placed.select("key", "rep", "component", "at_base", F.when(F.col("probe"), F.col("at_probe")).alias("at_probe"), F.explode(cells).alias("cell"))
    blocks = placed.select(
        "key", "rep", "component", F.col("cell.p").alias("p"), F.col("cell.b").alias("b"),
        (F.col("at_base") == F.col("cell.b")).alias("base"), F.coalesce(F.col("at_probe") == F.col("cell.p"), F.lit(False)).alias("probe"))
    blocks = blocks.join(texts.withColumnRenamed("doc_id", "rep"), "rep").groupBy("key", "p", "b")
    more = stage(blocks.applyInArrow(_block_links(size, percent), "a bigint, b bigint"), "more-links")
    labels = components(links.unionAll(more), "groups")

    groups = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        *prints, F.coalesce("component", "rep").alias("component_id"))
    plain = signed.drop("bands", "sketch")
    found = plain.join(groups, prints, "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    found = found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """The documents of which ``near_groups`` keeps the row, all columns as they are."""
    kept = near_groups(docs, percent, size).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    with_id = docs.join(kept, docs["doc_id"].cast("bigint") == kept["_kept"], "left_semi")
    return with_id.unionByName(docs.where("doc_id IS NULL"))
