"""Quote-level expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def spread_pct(bid: Column, ask: Column) -> Column:
    return F.try_divide(ask - bid, (bid + ask) / 2)


def price_vs_ask(price: Column, ask: Column) -> Column:
    return price - ask


def ask_touch_ratio(price: Column, bid: Column, ask: Column) -> Column:
    """Where in the spread the trade printed: 0 at bid, 1 at ask; locked market is 1 or 0."""
    locked = F.when(price >= ask, F.lit(1.0)).otherwise(F.lit(0.0))
    whole = price.isNotNull() & bid.isNotNull() & ask.isNotNull()
    return F.when(whole & (ask == bid), locked).when(whole, F.try_divide(price - bid, ask - bid))


def spread_bps(avg_spread: Column, avg_mid: Column) -> Column:
    return F.try_divide(avg_spread, avg_mid) * 10000


def dollar_volume(close: Column, volume: Column) -> Column:
    return close * volume
