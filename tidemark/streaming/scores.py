"""Trailing z-scores of bars on a stream of ticks that may come in any order and however late.

A micro-batch is folded into partial bars, which are kept under their batch number, so a replayed batch replaces its own rows
and nothing counts twice. A bar is the fold of its parts. A late tick changes its bar and the scores of those after it: for each
symbol of a batch the bars from the earliest changed one on are scored again, over as many earlier days as hold ``n`` bars, and
upserted. The parts are the state: a versioned table in the shared folder, so neither memory nor a watermark bounds lateness.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import whole_number
from ..functions.times import tumbling
from ..operators.windows import trailing_z
from ..shared import staged
from ..sources.sinks import read_upserted, upsert_path


def partial_bars(ticks: DataFrame, width: str = "30Min", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """What the ticks of one batch add to their bars. Missing price or size counts as zero; ticks without symbol or time drop."""
    rows = tumbling(ticks.where(F.col("symbol").isNotNull() & F.col(ts).isNotNull()), ts, width).select(
        "symbol", "bucket", F.coalesce(F.col("price"), F.lit(0.0)).alias("price"), whole_number(F.col("size")).alias("size"),
        F.col(ts).alias("ts"), F.col(seq).alias("seq"))
    tick = F.struct("ts", "seq", "price")
    return rows.groupBy("symbol", "bucket").agg(
        F.count(F.lit(1)).alias("count"), F.sum("size").alias("volume"), F.sum(F.col("price") * F.col("size")).alias("notional"),
        F.max("price").alias("high"), F.min("price").alias("low"), F.min(tick).alias("first"), F.max(tick).alias("last"))


def fold_bars(parts: DataFrame) -> DataFrame:
    """Bars from their parts, with the columns of ``trade_bars``."""
    bars = parts.groupBy("symbol", "bucket").agg(
        F.sum("count").alias("bar_trade_count"), F.sum("volume").alias("bar_volume"), F.sum("notional").alias("_notional"),
        F.min("first").alias("_first"), F.max("high").alias("bar_high"), F.min("low").alias("bar_low"), F.max("last").alias("_last"))
    return bars.select(
        "symbol", "bucket", "bar_trade_count", "bar_volume", F.col("_first.price").alias("bar_open"), "bar_high", "bar_low",
        F.col("_last.price").alias("bar_close"), F.col("_first.ts").alias("first_trade_ts"), F.col("_last.ts").alias("last_trade_ts"),
        F.round("_notional", 6).alias("trade_notional"), F.when(F.col("bar_volume") != 0, F.round(F.try_divide("_notional", "bar_volume"), 10)).alias("bar_vwap"))


def score_batch(ticks: DataFrame, batch: int, path: str, n: int, metrics: Sequence[str] = ("bar_volume",), width: str = "30Min") -> None:
    """Take a batch of ticks into the tables below ``path``; the same batch again leaves them as they are."""
    spark = ticks.sparkSession
    day = F.to_date("bucket").alias("day")
    parts = staged(partial_bars(ticks, width).select("*", day, F.lit(batch).cast("bigint").alias("batch")), "parts")
    if parts.isEmpty():
        return
    upsert_path(spark, f"{path}/parts", parts, ["day", "symbol", "bucket", "batch"], ["batch"], "day")
    held = read_upserted(spark, f"{path}/parts")
    since = parts.groupBy("symbol").agg(F.min("bucket").alias("since"))
    # the latest days before the first changed bar that hold n bars
    sizes = held.join(since, "symbol").where("bucket < since").select("symbol", "day", "bucket").distinct().groupBy("symbol", "day").agg(F.count("*").alias("bars"))
    later = Window.partitionBy("symbol").orderBy(F.col("day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = sizes.withColumn("later", F.coalesce(F.sum("bars").over(later), F.lit(0))).where(F.col("later") < n)
    floors = since.join(needed.groupBy("symbol").agg(F.min("day").alias("floor")), "symbol", "left").withColumn("floor", F.coalesce("floor", F.to_date("since")))
    floors = staged(floors, "floors")
    earliest = floors.agg(F.min("floor")).first()[0]  # prunes partitions
    history = held.where(F.col("day") >= F.lit(earliest)).join(floors, "symbol").where("day >= floor").select(held.columns)
    scored = trailing_z(fold_bars(history), ["symbol"], "bucket", ["bucket"], metrics, n)
    changed = scored.join(floors.select("symbol", "since"), "symbol").where("bucket >= since").drop("since")
    upsert_path(spark, f"{path}/bars", changed.select("*", day, F.lit(0).alias("_at")), ["day", "symbol", "bucket"], ["_at"], "day")


def score_stream(ticks: DataFrame, path: str, checkpoint: str, n: int = 20, metrics: Sequence[str] = ("bar_volume",), width: str = "30Min") -> StreamingQuery:
    """Score a stream of ticks (symbol, ts, seq, price, size). One stream writes to a path; read with :func:`scored_bars`."""
    take = lambda batch, number: score_batch(batch, number, path, n, metrics, width)
    return ticks.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scored_bars(spark, path: str) -> DataFrame:
    """All bars so far with their scores, late ticks included."""
    return read_upserted(spark, f"{path}/bars").drop("day")
