"""Visibility epochs: what a snapshot sees changes only when a bar becomes visible.

Snapshots are numbered 0, 1, ... in time. A state (an indicator row, a close) is seen by a run of snapshots, its epoch:
from the first snapshot at or after its ``available`` time to the last before the key's next one. Features are
computed once per epoch and spread over snapshots only at the end (``expand``), so half-hour snapshots cost no
more than daily ones until then. A table of epochs has key columns, ``first_no`` and ``last_no``.

The grid holds a row for each calendar day between the first and the last snapshot, which the calendar bounds.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..shared import staged


@dataclass(frozen=True)
class Grid:
    """``days``: day, base (number of the day's first snapshot), times (of the day's snapshots, in order)."""

    days: DataFrame
    first: datetime.date
    last: datetime.date
    n: int

    @property
    def numbers(self) -> DataFrame:
        """no, snapshot_time of every snapshot."""
        return self.days.select("base", F.posexplode("times").alias("_k", "snapshot_time")).select(
            (F.col("base") + F.col("_k")).alias("no"), "snapshot_time")


def snapshot_grid(snapshots: DataFrame) -> Grid:
    """Numbers the distinct ``snapshot_time`` values; null ones are none."""
    at = snapshots.select("snapshot_time").where(F.col("snapshot_time").isNotNull())
    by_day = at.groupBy(F.to_date("snapshot_time").alias("day")).agg(F.array_sort(F.collect_set("snapshot_time")).alias("times"))
    span = by_day.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    spine = span.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("day"))
    size = F.coalesce(F.size("times"), F.lit(0))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # one row a calendar day
    filled = spine.join(by_day, "day", "left").withColumn("_n", F.when(F.col("times").isNull(), 0).otherwise(size))
    days = filled.select("day", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("int").alias("base"),
                         F.coalesce("times", F.array().cast("array<timestamp_ntz>")).alias("times"), "_n")
    days = staged(days, "grid")
    first, last, n = days.agg(F.min("day"), F.max("day"), F.sum("_n")).first()
    return Grid(days.drop("_n"), first, last, n or 0)


def first_seen(df: DataFrame, at: str, grid: Grid) -> DataFrame:
    """The rows with ``first_no``, the first snapshot at or after the time ``at``; rows that no snapshot sees are left out."""
    if not grid.n:
        return df.where(F.lit(False)).withColumn("first_no", F.lit(0))
    day = F.greatest(F.to_date(at), F.lit(grid.first))
    earlier = F.size(F.filter("times", lambda t: t < F.col(at)))
    seen = df.withColumn("_day", day).where(F.to_date(at) <= F.lit(grid.last)).join(grid.days.withColumnRenamed("day", "_day"), "_day")
    return seen.withColumn("first_no", F.col("base") + earlier).drop("_day", "base", "times").where(F.col("first_no") < grid.n)


def _runs(starts: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Rows with last_no: up to the snapshot before the key's next row."""
    after = Window.partitionBy(*keys).orderBy("first_no")
    return starts.withColumn("last_no", F.coalesce(F.lead("first_no").over(after) - 1, F.lit(grid.n - 1)))


def epochs(
    states: DataFrame, grid: Grid, keys: Sequence[str], columns: Sequence[str], available: str | Column = "available_time", ts: str = "ts",
    listed: DataFrame | None = None,
) -> DataFrame:
    """Epochs of each key's states, with the state's ``columns``.

    At a snapshot the state with the latest (available, ts) counts; states that are replaced before any snapshot sees
    them never appear. With ``listed`` (key columns) exactly these keys come back, covering all snapshots: null columns
    where nothing is visible yet. The last state is found by a map-side combined maximum, so many states between two
    snapshots are no skew.
    """
    keys = list(keys)
    at = F.col(available) if isinstance(available, str) else available
    rows = states.select(*keys, F.struct(*[F.col(c) for c in columns]).alias("_state"), at.alias("_at"), F.col(ts).alias("_ts"))
    if listed is not None:
        listed = listed.select(*keys).distinct()
        rows = rows.join(listed, keys, "left_semi")
    rows = first_seen(rows, "_at", grid).select(*keys, "first_no", "_state", F.struct("_at", "_ts").alias("_order"))
    if listed is not None and grid.n:
        rows = rows.unionByName(listed.withColumn("first_no", F.lit(0)), allowMissingColumns=True)
    one = rows.groupBy(*keys, "first_no").agg(F.max_by("_state", "_order").alias("_state"))  # a null order counts only alone
    return _runs(one, keys, grid).select(*keys, "first_no", "last_no", *[F.col("_state")[c].alias(c) for c in columns])


def merged(legs: Sequence[tuple[DataFrame, dict[str, str]]], keys: Sequence[str], grid: Grid, listed: DataFrame | None = None) -> DataFrame:
    """Epochs in which none of several legs changes.

    Each leg: (epochs with the key columns, {its column: output name}). A change point of one leg keeps the state of
    the others. ``listed``: keys that must cover all snapshots.
    """
    keys, rows = list(keys), None
    for i, (leg, names) in enumerate(legs):
        part = leg.select(*keys, "first_no", F.struct(*[F.col(c) for c in names]).alias(f"_leg{i}"))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if listed is not None and grid.n:
        rows = rows.unionByName(listed.select(*keys, F.lit(0).alias("first_no")).distinct(), allowMissingColumns=True)
    points = rows.groupBy(*keys, "first_no").agg(*[F.first(f"_leg{i}", ignorenulls=True).alias(f"_leg{i}") for i in range(len(legs))])
    upto = Window.partitionBy(*keys).orderBy("first_no").rowsBetween(Window.unboundedPreceding, 0)
    points = points.withColumns({f"_leg{i}": F.last(f"_leg{i}", ignorenulls=True).over(upto) for i in range(len(legs))})
    out = [F.col(f"_leg{i}")[c].alias(name) for i, (_, names) in enumerate(legs) for c, name in names.items()]
    return _runs(points, keys, grid).select(*keys, "first_no", "last_no", *out)


def pair_epochs(states: DataFrame, pairs: DataFrame, pair_columns: Sequence[str], columns: Sequence[str], grid: Grid) -> DataFrame:
    """Epochs of each pair (``pair_columns`` with numerator and denominator): both legs' columns as ``num_*`` and ``den_*``.

    ``states``: epochs by symbol. Every pair covers all snapshots.
    """
    wanted = pairs.select(*pair_columns).distinct()
    legs = []
    for side, prefix in (("numerator", "num_"), ("denominator", "den_")):
        leg = wanted.join(states.select(F.col("symbol").alias(side), "first_no", *columns), side)
        legs.append((leg, {c: f"{prefix}{c}" for c in columns}))
    return merged(legs, pair_columns, grid, listed=wanted)


def common_epochs(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``spans`` cut at every change point of their key: each comes back once per epoch of the key that it covers.

    All rows of an epoch have the same first_no and last_no. Keys must not be null; without keys all rows share their
    epochs. A key has no more change points than there are snapshots.
    """
    keys, order = list(keys), Window.partitionBy(*keys).orderBy("at")
    starts = spans.select(*keys, F.col("first_no").alias("at")).unionByName(spans.select(*keys, (F.col("last_no") + 1).alias("at"))).distinct()
    points = starts.select(*keys, "at", F.row_number().over(order).alias("_e"), (F.lead("at").over(order) - 1).alias("_to"))
    begins = points.select(*keys, F.col("at").alias("first_no"), F.col("_e").alias("_first"))
    ends = points.select(*keys, (F.col("at") - 1).alias("last_no"), (F.col("_e") - 1).alias("_last"))
    cut = spans.join(begins, [*keys, "first_no"]).join(ends, [*keys, "last_no"])
    cut = cut.withColumn("_e", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last", "first_no", "last_no")
    runs = points.where(F.col("_to").isNotNull()).select(*keys, "_e", F.col("at").alias("first_no"), F.col("_to").alias("last_no"))
    return cut.join(runs, [*keys, "_e"]).drop("_e")


def expand(spans: DataFrame, grid: Grid) -> DataFrame:
    """The rows of ``spans`` at each snapshot they cover: ``snapshot_time`` in place of first_no and last_no."""
    rest = [c for c in spans.columns if c not in ("first_no", "last_no")]
    each = spans.withColumn("no", F.explode(F.sequence("first_no", "last_no")))
    return each.join(grid.numbers, "no").select("snapshot_time", *rest)


def with_times(spans: DataFrame, grid: Grid) -> DataFrame:
    """``first_snapshot``, ``last_snapshot`` and ``n_snapshots`` in place of first_no and last_no."""
    rest = [c for c in spans.columns if c not in ("first_no", "last_no")]
    first = grid.numbers.select(F.col("no").alias("first_no"), F.col("snapshot_time").alias("first_snapshot"))
    last = grid.numbers.select(F.col("no").alias("last_no"), F.col("snapshot_time").alias("last_snapshot"))
    n = (F.col("last_no") - F.col("first_no") + 1).cast("bigint").alias("n_snapshots")
    return spans.join(first, "first_no").join(last, "last_no").select("first_snapshot", "last_snapshot", n, *rest)
