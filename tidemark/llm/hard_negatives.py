"""Hard negatives: for each anchor and positive, the best rows of other labels whose score lies in a window below the positive's.

Scores are integer inner products. Anchors close to each other form groups of about GROUP, each with a spanning tree of
short edges. Where a part of the rows meets a group, the root is scored against all of them; from a parent's score s of a
row c, a child at edge length e has a score within s - e |c| .. s + e |c|. Only rows whose interval overlaps a
window that is still open are scored again, and their exact scores bound the next edge; the others hand their wider interval on.
A window closes from below at the k-th best score known to lie in it.

Rows are cut into blocks around centres fitted to a bounded sample (SAMPLE rows); all rows are in a block, blocks of
many rows are split into parts of about ROWS, and the centre's score and the block's radius tell which groups have to
visit a block at all. Rounds visit a few blocks first, so that later ones meet narrower windows. Results are exact.
Parts stay where they are while the groups pass; a part is copied once per SLAB groups that may pass it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import stage
from .vectors import centres, dealt, matrix, nearest, products, sample, whole

SAMPLE, CENTRES = 4096, 48  # at most
ROWS, GROUP, SLAB = 4096, 48, 1024
ROUNDS = (2, None)  # blocks that each anchor has seen after a round; None: all that its windows reach
ENDS = (-(1 << 63), (1 << 63) - 1)

ANCHORS = "anchors array<struct<anchor_id: bigint, label: int, parent: int, edge: double, vector: array<double>>>"
WINDOWS = "windows array<struct<anchor_id: bigint, no: int, low: bigint, high: bigint>>"
FOUND = "group bigint, anchor_id bigint, no int, vec_id bigint, score bigint"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label (int) and vector (array<double>) of rows that have all three, the vector without null, NaN or infinite
    components. Of rows with one vec_id that with the largest (vector, label) counts."""
    typed = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.struct(F.col("vector").cast("array<double>").alias("vector"), F.col("label").cast("int").alias("label")).alias("r"))
    typed = typed.where(F.col("vec_id").isNotNull() & F.col("r.label").isNotNull() & whole("r.vector"))
    return typed.groupBy("vec_id").agg(F.max("r").alias("r")).select("vec_id", "r.label", "r.vector")


def spanning_tree(x: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """(row, place of its parent or -1, edge length) in an order that has parents first: Prim's tree from the row nearest the mean."""
    n = len(x)
    near = np.sqrt(nearest(x, x))
    order, parents, edges = [int(nearest(x, x.mean(0, keepdims=True)).argmin())], [-1], [0.0]
    reach, via = near[order[0]].copy(), np.zeros(n, int)
    reach[order[0]] = np.inf
    for _ in range(n - 1):
        best = int(reach.argmin())
        order.append(best)
        parents.append(int(via[best]))
        edges.append(float(np.sqrt(((x[best] - x[order[via[best]]]) ** 2).sum())) * (1 + 1e-9))
        closer = near[best] < reach
        closer[order] = False
        reach[closer], via[closer] = near[best][closer], len(order) - 1
        reach[best] = np.inf
    return order, parents, edges


def grow_trees(width: int):
    """One row for each group of anchors: its spanning tree, parents first."""
    def of(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        order, parents, edges = spanning_tree(matrix(table["vector"], width))
        table = table.take(pa.array(order)).combine_chunks()
        nodes = pa.StructArray.from_arrays([table["vec_id"].combine_chunks(), table["label"].combine_chunks(), pa.array(parents, pa.int32()), pa.array(edges), table["vector"].combine_chunks()],
                                           ["anchor_id", "label", "parent", "edge", "vector"])
        return pa.table({"group": table["group"].slice(0, 1), "anchors": pa.ListArray.from_arrays(pa.array([0, len(nodes)], pa.int32()), nodes)})

    return of


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= floor)
        return some[np.lexsort((ids[some], -score[some]))[:k]] if score.dtype != object else some[sorted(range(len(some)), key=lambda i: (-score[some[i]], ids[some[i]]))[:k]]
    return np.array(sorted(range(len(score)), key=lambda i: (-score[i], ids[i]))[:k], int)


def windows_in_part(part: tuple, nodes: list[tuple], windows: dict, same: bool, k: int) -> Iterator[tuple]:
    """(anchor_id, no, vec_id, score) of the k best rows of a part in each window, walking the tree of a group.

    ``nodes``: (anchor_id, label, parent, edge, vector); ``windows``: {anchor_id: [(no, low, high)]}.
    """
    ids, labels, x, norm = part
    lows, highs, children = [], [], np.bincount([p for _, _, p, _, _ in nodes if p >= 0], minlength=len(nodes))
    for place, (anchor, label, parent, edge, vector) in enumerate(nodes):
        fits = (labels == label) & (ids != anchor) if same else labels != label
        slack = 1e-9 * float(np.sqrt(vector @ vector)) * norm + 1e-6
        if parent < 0:
            exact = products(vector[None], x)[0]
            low = high = exact.astype(float)
            low, high, known = low - slack, high + slack, np.ones(len(ids), bool)
        else:
            step = edge * norm + slack
            low, high = lows[parent] - step, highs[parent] + step
            known, exact = np.zeros(len(ids), bool), None
        asked = []
        for no, least, most in windows.get(anchor, ()):
            sure = fits & (low >= least) & (high <= most)
            if np.count_nonzero(sure) >= k:  # k rows are in the window: nothing below the k-th of their lower ends is wanted
                least = max(least, np.partition(low[sure], -k)[-k])
            asked.append((no, least, most, fits & (high >= least) & (low <= most)))
        if exact is None:
            exact = np.zeros(len(ids))
            for *_, open_ in asked:
                known |= open_
            if known.any():
                again = products(vector[None], x[known])[0]
                exact = exact.astype(again.dtype)
                exact[known] = again
                value = again.astype(float)
                low[known], high[known] = value - slack[known], value + slack[known]
        for no, least, most, open_ in asked:
            at = np.flatnonzero(open_)
            score = exact[at]
            inside = (score >= least) & (score <= most)
            at, score = at[inside], score[inside]
            for j in _best(score, ids[at], k).tolist():
                yield anchor, no, int(ids[at[j]]), int(score[j])
        lows.append(low if children[place] else None)
        highs.append(high if children[place] else None)


def best_in_windows(index: dict, trees: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
    """group, anchor_id, no, vec_id, score: the k best rows of each window (group, anchor_id, no, low, high; low to high
    inclusive) among the rows of the anchor's label (``same``) or of other labels. Staged."""
    parts, low_centre, width, slabs = index["parts"], index["centres"], index["width"], index["slabs"]
    radius, splits, first = index["radius"], index["splits"], index["first"]
    cells = int(first[-1])

    def visits(done: int, upto: int | None):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(len(batch)):
                    one = batch.slice(r, 1)
                    nodes = one.column("anchors").flatten()
                    ids = nodes.field("anchor_id").to_numpy()
                    x = matrix(nodes.field("vector"), width)
                    asked = one.column("windows").flatten()
                    who = np.searchsorted(ids, asked.field("anchor_id").to_numpy(), sorter=np.argsort(ids))
                    who = np.argsort(ids)[who]
                    mid, spread = x @ low_centre.T, np.sqrt((x * x).sum(1))[:, None] * radius * (1 + 1e-9) + 1e-6
                    low, high = asked.field("low").to_numpy().astype(float), asked.field("high").to_numpy().astype(float)
                    reach = ((mid + spread)[who] >= low[:, None]) & ((mid - spread)[who] <= high[:, None])
                    place = np.empty(reach.shape, int)  # blocks by the score of their centre, the highest first
                    np.put_along_axis(place, np.argsort(-mid, axis=1, kind="stable")[who], np.arange(len(splits))[None], 1)
                    # a round ends with every block seen that any anchor of the group has among its first ones, in reach or not
                    now = (place < upto).any(0) if upto else reach.any(0)
                    now &= (splits > 0) & ~(place < done).any(0)
                    go = np.concatenate([first[b] + np.arange(splits[b]) for b in np.flatnonzero(now)] or [np.zeros(0, int)])
                    yield pa.RecordBatch.from_arrays([pa.array(go.astype(np.int32)), *(one.column(c).take(pa.array(np.zeros(len(go), int))) for c in ("group", "anchors", "windows"))],
                                                     ["part", "group", "anchors", "windows"])

        return of

    def hold(table: pa.Table) -> tuple:
        x = matrix(table["vector"], width)
        return table["vec_id"].to_numpy(), table["label"].to_numpy(), x, np.sqrt((x * x).sum(1))

    def scan(state: tuple, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for r in range(len(batch)):
            nodes, asked = batch.column("anchors").slice(r, 1).flatten(), batch.column("windows").slice(r, 1).flatten()
            own: dict = {}
            for w in asked.to_pylist():
                own.setdefault(w["anchor_id"], []).append((w["no"], w["low"], w["high"]))
            x = matrix(nodes.field("vector"), width)
            tree = list(zip(*(nodes.field(c).to_pylist() for c in ("anchor_id", "label", "parent", "edge")), x))
            rows = list(windows_in_part(state, tree, own, same, k))
            columns = list(zip(*rows)) if rows else [()] * 4
            group = pa.array([batch.column("group")[r].as_py()] * len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([group, *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64())))],
                                             ["group", "anchor_id", "no", "vec_id", "score"])

    by_rank = W.partitionBy("anchor_id", "no").orderBy(F.col("score").desc(), "vec_id")
    best, done = None, 0
    for upto in ROUNDS:
        open_ = windows
        if best is not None:
            held = best.groupBy("anchor_id", "no").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
            open_ = windows.join(held, ["anchor_id", "no"], "left").withColumn("low", F.when(F.col("n") >= k, F.greatest("low", "kth")).otherwise(F.col("low")))
        lists = open_.groupBy("group").agg(F.collect_list(F.struct("anchor_id", "no", "low", "high")).alias("windows"))  # of about GROUP anchors
        todo = trees.join(lists, "group").select("group", "anchors", "windows")
        go = todo.mapInArrow(visits(done, upto), f"part int, group bigint, {ANCHORS}, {WINDOWS}")
        go = go.select((F.col("part") + F.pmod(F.xxhash64("group"), F.lit(slabs)) * cells).cast("int").alias("cell"), "group", "anchors", "windows")
        found = dealt(parts, go, cells * slabs, hold, scan, FOUND)
        if best is not None:
            found = found.unionByName(best)
        best = stage(found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k).drop("rank"), "windows")
        done = upto
    return best


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and vector of whole numbers; ``anchors`` has vec_id, and an anchor is the row of that id.
    An anchor's positives are the ``positives`` best other rows of its label; for each of them come the first
    ``negatives`` rows of other labels with least * p <= 100 * s <= most * p, where p and s are the scores of the positive and the negative (so
    none for a negative p). Higher scores come first, ties go to the smaller vec_id, and fewer come if there are fewer. Rows
    without vec_id, label or a whole vector take no part, on either side; vectors of unequal length count as filled with zeros. Products
    beyond a long are held to its range.
    """
    spark = rows.sparkSession
    kept = stage(usable(rows), "labelled")
    n, width = kept.agg(F.count("*"), F.max(F.size("vector"))).first()
    chosen = stage(kept.join(anchors.select(F.col("vec_id").cast("bigint").alias("vec_id")).distinct(), "vec_id", "left_semi"), "anchors")
    n_anchors = chosen.count()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    width = max(width, 1)

    points = centres(matrix(sample(kept, SAMPLE)["vector"], width), min(CENTRES, -(-n // ROWS)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = nearest(matrix(batch.column("vector"), width), points)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far.argmin(1).astype(np.int32)), pa.array(np.sqrt(far.min(1)))],
                                             [*batch.schema.names, "block", "far"])

    typed = "vec_id bigint, label int, vector array<double>, block int, far double"
    blocks = stage(kept.mapInArrow(placed, typed), "blocks")
    stats = blocks.groupBy("block").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()  # CENTRES rows at most
    rows_a_part = max(1, min(ROWS, -(-n // spark.sparkContext.defaultParallelism)))
    radius, splits = np.zeros(len(points)), np.zeros(len(points), np.int64)
    for r in stats:
        radius[r["block"]], splits[r["block"]] = r["far"] + 1e-6 * (1 + r["far"]), -(-r["n"] // rows_a_part)
    first = np.concatenate(([0], np.cumsum(splits)))
    lay = F.array(*[F.struct(F.lit(int(a)).alias("a"), F.lit(max(1, int(s))).alias("s")) for a, s in zip(first, splits)])[F.col("block")]
    part = blocks.withColumn("_lay", lay).select("vec_id", "label", "vector", (F.col("_lay.a") + F.pmod(F.xxhash64("vec_id"), F.col("_lay.s"))).cast("int").alias("part"))

    # anchors near the same hub make a group; a hub with many anchors has several
    hubs = centres(matrix(sample(chosen, SAMPLE)["vector"], width), min(CENTRES, -(-n_anchors // GROUP)))

    def at_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hub = nearest(matrix(batch.column("vector"), width), hubs).argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hub.astype(np.int32))], [*batch.schema.names, "hub"])

    homes = stage(chosen.mapInArrow(at_hub, "vec_id bigint, label int, vector array<double>, hub int"), "homes")
    sizes = {r["hub"]: -(-r["n"] // GROUP) for r in homes.groupBy("hub").agg(F.count("*").alias("n")).collect()}  # CENTRES rows at most
    shares = F.array(*[F.lit(sizes.get(h, 1)) for h in range(len(hubs))])[F.col("hub")]
    grouped = homes.select("vec_id", "label", "vector", (F.col("hub").cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("vec_id"), shares)).alias("group"))
    trees = stage(grouped.groupBy("group").applyInArrow(grow_trees(width), f"group bigint, {ANCHORS}"), "trees")
    slabs = -(-sum(sizes.values()) // SLAB)
    cells = int(first[-1])
    copies = part.select("vec_id", "label", "vector", F.explode(F.sequence(F.col("part"), F.col("part") + (slabs - 1) * cells, F.lit(cells))).alias("cell"))
    index = {"parts": copies, "centres": points, "radius": radius, "splits": splits, "first": first, "width": width, "slabs": slabs}

    every = grouped.select("group", F.col("vec_id").alias("anchor_id"), F.lit(1).alias("no"), F.lit(ENDS[0]).alias("low"), F.lit(ENDS[1]).alias("high"))
    good = best_in_windows(index, trees, every, True, positives)
    by_rank = W.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    good = stage(good.select("group", "anchor_id", F.row_number().over(by_rank).alias("no"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    p = F.col("positive_score").cast("decimal(20,0)")
    windows = good.select("group", "anchor_id", "no", F.ceil(p * least / 100).cast("bigint").alias("low"), F.floor(p * most / 100).cast("bigint").alias("high")).where("low <= high")
    bad = best_in_windows(index, trees, windows, False, negatives)
    in_window = W.partitionBy("anchor_id", "no").orderBy(F.col("score").desc(), "vec_id")
    ranked = bad.select("anchor_id", "no", F.row_number().over(in_window).alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return ranked.join(good, ["anchor_id", "no"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
