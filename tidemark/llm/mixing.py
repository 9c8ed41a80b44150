"""Mixing sources to target weights by subset-sum budget fitting.

Every source takes whole passes over its documents and then, for the budget that remains, a subset of
them: documents are counted by exact length, a bounded-knapsack program chooses how many of each length
fill the remaining budget to the word, and seeded ranks choose which. Only length counts reach one task
(a group per source, as long as its longest text at most); documents are ranked in hashed parts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import WORD, stage

WEIGHTS = (5, 2, 1)
SHARE, REPEAT = 1.5, 2  # mixture size as a share of all sizes, most passes over a source
PART = 1024  # ranked documents of one length in one group, about
SEED = 17
NEW = ("size", "source_size", "target", "copies", "taken")


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take, at most ``counts``, so that their sum comes nearest to ``budget``.

    The bulk is taken in proportion, so the choice looks like the source, then single documents in seeded
    order; the last part is an exact subset-sum over the lengths left. ``lengths`` are positive and distinct.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or total <= budget:
        return counts * int(budget > 0)
    taken = np.floor(counts * (budget / total)).astype(np.int64)
    left, short = counts - taken, budget - int((lengths * taken).sum())
    window = 2 * int(lengths.max())
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        if short <= window:
            break
        if left[i]:
            left[i] -= 1
            taken[i] += 1
            short -= int(lengths[i])
    # sums up to one length beyond the budget; ``by`` is the item that first reached a sum
    top = max(0, short) + int(lengths.max())
    reach, by, items = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int64), []
    reach[0] = True
    for i in np.argsort(-lengths):
        many, step = int(min(left[i], top // lengths[i])), 1
        while many > 0 and not reach[short]:
            step = min(step, many)
            size = int(lengths[i]) * step
            fresh = np.flatnonzero(reach[: top + 1 - size] & ~reach[size:]) + size
            reach[fresh], by[fresh] = True, len(items)
            items.append((i, step, size))
            many, step = many - step, step * 2
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - short))])
    while at:
        i, step, size = items[by[at]]
        taken[i] += step
        at -= size
    return taken


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``sizes`` (source, source_size) with target: the share by weight, at most ``repeat`` times the source.

    Sources are ordered by code point, null last, and weights repeat in that order. Sources reach their limit
    in the order of limit by weight, so one pass over the sources (a row each) settles every reshare.
    """
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    rows = sizes.withColumns({"w": weight, "cap": (F.col("source_size") * repeat).cast("double")})
    by_limit = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = by_limit.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    rows = rows.withColumns({
        "_rest": F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "_weights": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    })
    rows = rows.withColumn("_level", F.col("_rest") / F.col("_weights"))
    ratio = F.col("cap") / F.col("w")
    level = F.min(F.when(ratio > F.col("_level"), F.struct(ratio, "_level"))).over(everything)["_level"]  # of the first that stays below its limit
    return rows.select("source", "source_size", F.least("cap", F.coalesce(level * F.col("w"), "cap")).alias("target"))


def _plan(source: pd.DataFrame) -> pd.DataFrame:
    lengths, counts = source["size"].to_numpy(np.int64), source["n"].to_numpy(np.int64)
    order = np.argsort(lengths)
    size, target = int(source["source_size"].iloc[0]), float(source["target"].iloc[0])
    passes = int(target // size) if size else 0
    budget = int(np.floor(target - passes * size + 0.5))
    extra = np.zeros(len(lengths), np.int64)
    full = order[lengths[order] > 0]
    if len(full):
        extra[full] = fit_lengths(lengths[full], counts[full], budget)
    return pd.DataFrame({"_src": source["_src"], "size": lengths, "passes": passes, "extra": extra, "n": counts,
                         "source_size": size, "target": target})


def _chosen(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` as c0, c1, ... (so none can clash with the ones made here) and those of ``NEW``."""
    # null and the text of any source stay apart
    src = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    made = [src.alias("_src"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.xxhash64("doc_id", "text", "source", F.lit(SEED)).alias("_at")]
    slim = stage(docs.select(*made), "sizes")  # words are counted once for all that follows but the last join
    counts = stage(slim.groupBy("_src", "source", "size").agg(F.count("*").alias("n")), "lengths")
    sizes = counts.groupBy("_src", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(sizes.select("source", "source_size")).withColumn("_src", src).drop("source")
    plan = counts.select("_src", "size", "n").join(goals, "_src").groupBy("_src").applyInPandas(
        _plan, "_src string, size bigint, passes bigint, extra bigint, n bigint, source_size bigint, target double")
    plan = stage(plan, "plan")

    # of n documents of a length the ``extra`` lowest hashes: whole parts below a cut part, ranks within it
    spots = slim.select("_src", "size", "_at").join(plan.where("extra > 0 AND extra < n"), ["_src", "size"])
    part = F.floor((F.col("_at") / 2.0**64 + 0.5) * F.ceil(F.col("n") / PART))
    spots = stage(spots.select("_src", "size", "_at", "extra", part.alias("part")), "spots")
    by_length = W.partitionBy("_src", "size")
    parts = spots.groupBy("_src", "size", "part").agg(F.count("*").alias("m"), F.first("extra").alias("extra"))
    parts = parts.withColumn("before", F.sum("m").over(by_length.orderBy("part")) - F.col("m"))
    cut = parts.where("before < extra AND before + m >= extra").select("_src", "size", "part", (F.col("extra") - F.col("before")).alias("need"))
    ranked = spots.join(cut, ["_src", "size", "part"]).withColumn("rank", F.row_number().over(W.partitionBy("_src", "size", "part").orderBy("_at")))
    edge = ranked.where("rank = need").select("_src", "size", F.col("_at").alias("_edge"), "need")
    # equal hashes at the edge belong to equal rows: count how many of them still fit
    low = ranked.join(edge.drop("need"), ["_src", "size"]).where("_at <= _edge").groupBy("_src", "size").agg(
        F.max("_edge").alias("_edge"), F.count("*").alias("_upto"), F.count_if(F.expr("_at = _edge")).alias("_ties"), F.count_if(F.expr("_at < _edge")).alias("_under"))
    edge = edge.join(low.drop("_edge"), ["_src", "size"]).select("_src", "size", "_edge", (F.col("need") - F.col("_under")).alias("_fit"), "_ties")
    choice = stage(plan.join(edge, ["_src", "size"], "left").drop("n"), "choice")
    found = docs.select(*own, *made).drop("source").join(choice, ["_src", "size"])
    tie = F.when(F.col("_ties") == F.col("_fit"), True)
    found = found.withColumn("_in", F.when(F.col("extra") == 0, False).when(F.col("_edge").isNull(), True)
                             .when(F.col("_at") < F.col("_edge"), True).when(F.col("_at") > F.col("_edge"), False).otherwise(tie))
    sure = found.where("_in IS NOT NULL")
    ties = found.where("_in IS NULL").withColumn("_in", F.row_number().over(W.partitionBy("_src", "size").orderBy("_at")) <= F.col("_fit"))
    if choice.where("_ties > _fit").isEmpty():  # no length has equal rows across its edge
        out = sure
    else:
        out = sure.unionByName(ties)
    copies = F.col("passes") + F.col("_in").cast("int")
    return out.withColumns({"copies": copies, "taken": F.col("size") * copies})


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source, further columns) with size, source_size, target, copies and taken.

    Columns of these names in the input give way, others of any name stay. size is the number of words of the
    whole text, however long (null text: 0), taken the words the mixture takes of a row, repeats counted:
    a whole number of times its size, twice at most. Null is a source of its own, the last. Documents are
    chosen by a seeded hash of doc_id, text and source, so reruns agree; equal rows tie and any of them serves.
    An empty table gives no rows; a source without words has the target 0.
    """
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in NEW]
    return _chosen(docs).select(*own, *NEW)


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of the mixture: every document as often as ``mixed`` takes it, its columns as they are."""
    rows = _chosen(docs).where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
