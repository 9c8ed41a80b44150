"""Multi-feed source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.symbols import option_symbol, right_normalize
from ..functions.times import normalize_timeframe
from ..operators.bars import liquidity_bars, quote_bars, trade_bars
from ..operators.joins import bars_with_liquidity, interval_join, last_wins

STRATEGY_COLUMNS = (
    "symbol", "timeframe", "timestamp", "bar_open", "bar_high", "bar_low", "bar_close", "bar_volume", "bar_vwap",
    "bar_trade_count", "dollar_volume", "quote_count", "avg_bid", "avg_ask", "avg_bid_size", "avg_ask_size",
    "avg_spread", "spread_bps", "last_bid", "last_ask",
)
EXIT_EXTENSION_HOURS = 1


def strategy_bars(bars: DataFrame, trades: DataFrame, quotes: DataFrame, width: str = "1Min") -> DataFrame:
    """Provider bars joined with the liquidity of their interval; liquidity-only intervals stay.

    ``bars``: symbol, bucket and bar columns.
    """
    liquidity = liquidity_bars(trade_bars(trades, width), quote_bars(quotes, width))
    joined = bars_with_liquidity(bars.withColumn("bar_volume", F.col("bar_volume").cast("double")), liquidity)
    return joined.select(
        *[F.col("bucket").alias(c) if c == "timestamp" else F.lit(width).alias(c) if c == "timeframe" else F.col(c)
          for c in STRATEGY_COLUMNS]
    )


def market_bars(bars: DataFrame, universe: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Universe bars with the bar width reviewed for their symbol; of several rows the last by ``order`` counts."""
    grain = universe.where((F.trim("symbol") != "") & (F.trim("bar_grain") != "")).select(
        F.upper(F.trim("symbol")).alias("symbol"), normalize_timeframe(F.col("bar_grain")).alias("timeframe"), *order
    )
    grain = last_wins(grain, ["symbol"], list(order) or ["timeframe"]).select("symbol", "timeframe")
    return bars.drop("timeframe").join(grain, "symbol")


def first_present(df: DataFrame, *names: str) -> Column:
    """The first of several alternative column names that holds a value."""
    found = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None)


def field_aliases(df: DataFrame) -> dict[str, Column]:
    """Bar fields under either of their names."""
    out = {f"bar_{n}": first_present(df, f"bar_{n}", n).try_cast("double") for n in ("open", "high", "low", "close", "volume", "vwap")}
    count = first_present(df, "bar_trade_count", "trade_count", "count").try_cast("double").cast("bigint")
    out["bar_trade_count"] = count
    return out


def position_bars(
    rows: DataFrame, contracts: DataFrame, on: str = "option_symbol", timeframe: str = "1Min", extra: Sequence[str] = ()
) -> DataFrame:
    """Bars of selected contracts inside their holding window, plus one hour after the exit.

    ``contracts``: underlying, option_symbol (or blank), expiration, option_right_type, strike,
    entry_time, exit_time.
    """
    right = right_normalize(F.col("option_right_type"))
    symbol = F.coalesce(
        F.nullif(F.upper(F.trim("option_symbol")), F.lit("")),
        option_symbol(F.col("underlying"), F.col("expiration"), right, F.col("strike").cast("double")),
    )
    spans = contracts.withColumns({"option_right_type": right, "option_symbol": symbol, "underlying": F.upper("underlying")})
    hits = interval_join(
        rows.where(F.col("ts").isNotNull()), spans, [on], "ts", "entry_time", "exit_time",
        F.make_dt_interval(hours=F.lit(EXIT_EXTENSION_HOURS)),
    )
    fields = field_aliases(hits)
    grain = F.coalesce(F.col("timeframe"), F.lit(timeframe)) if "timeframe" in hits.columns else F.lit(timeframe)
    return hits.select(
        "underlying",
        "option_symbol",
        F.col("expiration").cast("string").alias("expiration"),
        "option_right_type",
        F.col("strike").cast("double").alias("strike"),
        grain.alias("timeframe"),
        F.col("ts").alias("timestamp"),
        *[fields[n].alias(n) for n in ("bar_open", "bar_high", "bar_low", "bar_close", "bar_volume", "bar_trade_count", "bar_vwap")],
        *extra,
    )
