"""Tick to bar aggregation.

All aggregates here are decomposable, so Spark combines them map-side: what is
shuffled is one partial row per (key, bucket) and task, never the ticks of a hot
symbol.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import whole_number
from ..functions.times import tumbling

SYMBOL = ("symbol",)


def _order(ts: str, seq: str | None) -> Column:
    """Position of a tick in its bar. Without ``seq`` timestamps must be unique per key."""
    return F.col(ts) if seq is None else F.struct(F.col(ts), F.col(seq))


def _vwap(notional: Column, volume: Column, places: int = 10) -> Column:
    return F.when(volume != 0, F.round(F.try_divide(notional, volume), places))


def trade_bars(
    trades: DataFrame, width: str = "30Min", keys: Sequence[str] = SYMBOL, ts: str = "ts", seq: str | None = "seq"
) -> DataFrame:
    """Trades (price, size) to OHLC, volume, notional, count and VWAP per bucket.

    A missing price or size counts as zero.
    """
    return aggregate_trades(tumbling(trades, ts, width), [*keys, "bucket"], ts, seq)


def aggregate_trades(ticks: DataFrame, group: Sequence[str], ts: str, seq: str | None) -> DataFrame:
    """The bar aggregation itself, for ticks that already carry their bucket."""
    ticks = ticks.select(
        *group,
        F.col(ts).alias("_ts"),
        _order(ts, seq).alias("_order"),
        F.coalesce(F.col("price"), F.lit(0.0)).alias("_price"),
        whole_number(F.col("size")).alias("_size"),
    )
    grouped = ticks.groupBy(*group).agg(
        F.count(F.lit(1)).alias("bar_trade_count"),
        F.sum("_size").alias("bar_volume"),
        F.sum(F.col("_price") * F.col("_size")).alias("_notional"),
        F.min_by("_price", "_order").alias("bar_open"),
        F.max("_price").alias("bar_high"),
        F.min("_price").alias("bar_low"),
        F.max_by("_price", "_order").alias("bar_close"),
        F.min("_ts").alias("first_trade_ts"),
        F.max("_ts").alias("last_trade_ts"),
    )
    return grouped.withColumns(
        {
            "trade_notional": F.round("_notional", 6),
            "bar_vwap": _vwap(F.col("_notional"), F.col("bar_volume")),
        }
    ).drop("_notional")


def quote_bars(
    quotes: DataFrame, width: str = "30Min", keys: Sequence[str] = SYMBOL, ts: str = "ts", seq: str | None = "seq"
) -> DataFrame:
    """Quotes (bid, ask, sizes) to averages, spread range and last quote per bucket.

    ``avg_mid`` divides by every quote while ``avg_spread`` divides by two-sided
    quotes only; a missing side counts as zero in its own average.
    """
    bid = F.coalesce(F.col("bid"), F.lit(0.0))
    ask = F.coalesce(F.col("ask"), F.lit(0.0))
    two_sided = (bid != 0) & (ask != 0)
    ticks = tumbling(quotes, ts, width).select(
        *keys,
        "bucket",
        F.col(ts).alias("_ts"),
        _order(ts, seq).alias("_order"),
        bid.alias("_bid"),
        ask.alias("_ask"),
        F.when(two_sided, (ask + bid) / 2).alias("_mid"),
        F.when(two_sided, ask - bid).alias("_spread"),
        whole_number(F.col("bid_size")).alias("_bs"),
        whole_number(F.col("ask_size")).alias("_as"),
    )
    n = F.count(F.lit(1))
    return ticks.groupBy(*keys, "bucket").agg(
        n.alias("quote_count"),
        F.round(F.sum("_bid") / n, 10).alias("avg_bid"),
        F.round(F.sum("_ask") / n, 10).alias("avg_ask"),
        F.round(F.coalesce(F.sum("_mid"), F.lit(0.0)) / n, 10).alias("avg_mid"),
        F.round(F.avg("_spread"), 10).alias("avg_spread"),
        F.min("_spread").alias("min_spread"),
        F.max("_spread").alias("max_spread"),
        F.round(F.sum("_bs") / n, 10).alias("avg_bid_size"),
        F.round(F.sum("_as") / n, 10).alias("avg_ask_size"),
        F.max_by("_bid", "_order").alias("last_bid"),
        F.max_by("_ask", "_order").alias("last_ask"),
        F.max_by("_mid", "_order").alias("last_mid"),
        F.min("_ts").alias("first_quote_ts"),
        F.max("_ts").alias("last_quote_ts"),
    )


LIQUIDITY_COLUMNS = (
    "bar_trade_count", "quote_count", "bar_volume", "bar_vwap", "bar_open", "bar_high", "bar_low", "bar_close",
    "avg_bid", "avg_ask", "avg_mid", "avg_spread", "min_spread", "max_spread", "avg_bid_size", "avg_ask_size",
    "last_bid", "last_ask", "last_mid",
)


def liquidity_bars(trade: DataFrame, quote: DataFrame, keys: Sequence[str] = SYMBOL) -> DataFrame:
    """FULL OUTER join of trade bars and quote bars on key and bucket.

    Both sides come out of an aggregation hashed on the same key, so the join adds no shuffle.
    """
    on = [*keys, "bucket"]
    zero = F.lit(0).cast("bigint")
    joined = trade.join(quote, on, "full_outer").withColumns(
        {name: F.coalesce(F.col(name), zero) for name in ("bar_trade_count", "quote_count", "bar_volume")}
    )
    return joined.select(
        *on,
        *LIQUIDITY_COLUMNS,
        F.col("bar_close").alias("last_trade_price"),
        F.round(F.col("bar_vwap") - F.col("avg_mid"), 10).alias("bar_vwap_minus_avg_mid"),
    )


QUOTELESS = ("avg_bid", "avg_ask", "avg_mid", "avg_spread", "last_bid", "last_ask", "last_mid", "bar_vwap_minus_avg_mid")


def crypto_trade_bars(
    trades: DataFrame, width: str = "1Min", keys: Sequence[str] = SYMBOL, ts: str = "ts", seq: str | None = "seq"
) -> DataFrame:
    """Trade bars with fractional size; volume and notional are rounded before VWAP."""
    ticks = tumbling(trades, ts, width).select(
        *keys, "bucket", _order(ts, seq).alias("_order"), F.col("price").alias("_price"), F.col("size").alias("_size")
    )
    grouped = ticks.groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("bar_trade_count"),
        F.round(F.sum("_size"), 12).alias("bar_volume"),
        F.round(F.sum(F.col("_price") * F.col("_size")), 12).alias("trade_notional"),
        F.min_by("_price", "_order").alias("bar_open"),
        F.max("_price").alias("bar_high"),
        F.min("_price").alias("bar_low"),
        F.max_by("_price", "_order").alias("bar_close"),
    )
    return grouped.withColumns(
        {
            "bar_vwap": _vwap(F.col("trade_notional"), F.col("bar_volume")),
            "quote_count": F.lit(None).cast("bigint"),
            **{name: F.lit(None).cast("double") for name in QUOTELESS},
        }
    )


CONTRACT = ("underlying", "expiration", "option_right_type", "strike")


def active_ohlc(rows: DataFrame) -> DataFrame:
    """Drop placeholder rows: no volume and no trades, or no readable time."""
    return rows.where(
        F.col("ts").isNotNull() & ((whole_number(F.col("volume")) > 0) | (whole_number(F.col("count")) > 0))
    )


def option_bars(
    rows: DataFrame, width: str = "30Min", keys: Sequence[str] = CONTRACT, ts: str = "ts", seq: str | None = "seq"
) -> DataFrame:
    """One-second OHLC rows to bars; a zero price means missing.

    The first row's price stays when no non-zero price follows in the bucket.
    """
    ticks = (
        tumbling(active_ohlc(rows), ts, width)
        .withColumns({"_order": _order(ts, seq), "_v": whole_number(F.col("volume")), "_n": whole_number(F.col("count"))})
        .withColumn(
            "_px", F.when(F.col("close").isNotNull() & (F.col("close") != 0), F.col("close")).otherwise(F.col("vwap"))
        )
    )

    def priced(name: str) -> Column:
        return F.when(F.col(name) != 0, F.col("_order"))

    def first_row(name: str) -> Column:
        return F.min_by(name, "_order")

    def nonzero(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(0.0))

    grouped = ticks.groupBy(*keys, "bucket").agg(
        F.coalesce(F.min_by("open", priced("open")), first_row("open")).alias("bar_open"),
        F.coalesce(F.max(nonzero("high")), first_row("high")).alias("bar_high"),
        F.coalesce(F.min(nonzero("low")), first_row("low")).alias("bar_low"),
        F.coalesce(F.max_by("close", priced("close")), first_row("close")).alias("bar_close"),
        F.sum("_v").alias("bar_volume"),
        F.sum("_n").alias("bar_trade_count"),
        F.coalesce(F.sum(F.col("_px") * F.col("_v")), F.lit(0.0)).alias("_notional"),
    )
    return grouped.withColumn("bar_vwap", _vwap(F.col("_notional"), F.col("bar_volume"))).drop("_notional")
