"""Queries: tick aggregation and outer joins of bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import bucket_start, tumbling
from ..operators import bars as B, joins as J
from ..plans.sources import strategy_bars
from . import proxies as P
from .registry import cte, query, r, rlist, rounded, rs


@query("tumbling_bucket_et", """
SELECT event_id, time_bucket(INTERVAL '1 second', ts) AS b_1s, time_bucket(INTERVAL '1 minute', ts) AS b_1m,
  time_bucket(INTERVAL '5 minutes', ts) AS b_5m, time_bucket(INTERVAL '15 minutes', ts) AS b_15m,
  time_bucket(INTERVAL '30 minutes', ts) AS b_30m, time_bucket(INTERVAL '1 hour', ts) AS b_1h, date_trunc('day', ts) AS b_1d
FROM events""")
def tumbling_bucket_et(spark, d):
    df = P.table(spark, d, "events").select("event_id", "ts")
    names = {"1Sec": "b_1s", "1Min": "b_1m", "5Min": "b_5m", "15Min": "b_15m", "30Min": "b_30m", "1Hour": "b_1h"}
    for width, name in names.items():
        df = tumbling(df, "ts", width, name)
    return df.withColumn("b_1d", bucket_start(F.col("ts"), "1Day")).drop("ts")


TRADE = ("trade_notional", "bar_vwap", "bar_open", "bar_high", "bar_low", "bar_close")


@query("trade_bars", f"""
SELECT symbol, bucket, bar_trade_count, bar_volume, {rlist('bar_open', 'bar_high', 'bar_low', 'bar_close', 'bar_vwap')},
  {rs('notional')} AS trade_notional, first_trade_ts, last_trade_ts FROM tb""")
def trade_bars(spark, d):
    return rounded(P.bars30(spark, d), *TRADE)


QUOTE = ("avg_bid", "avg_ask", "avg_mid", "avg_spread", "min_spread", "max_spread", "avg_bid_size", "avg_ask_size",
         "last_bid", "last_ask", "last_mid")


@query("quote_bars", f"SELECT symbol, bucket, quote_count, {rlist(*QUOTE)}, first_quote_ts, last_quote_ts FROM qb")
def quote_bars(spark, d):
    return rounded(P.quotes30(spark, d), *QUOTE)


cte("liq", """SELECT coalesce(t.symbol, q.symbol) AS symbol, coalesce(t.bucket, q.bucket) AS bucket,
  coalesce(bar_trade_count, 0) AS bar_trade_count, coalesce(quote_count, 0) AS quote_count, coalesce(bar_volume, 0) AS bar_volume,
  bar_vwap, bar_open, bar_high, bar_low, bar_close, avg_bid, avg_ask, avg_mid, avg_spread, min_spread, max_spread,
  avg_bid_size, avg_ask_size, last_bid, last_ask, last_mid, bar_close AS last_trade_price, bar_vwap - avg_mid AS bar_vwap_minus_avg_mid
  FROM tb_gap t FULL OUTER JOIN qb_gap q ON t.symbol = q.symbol AND t.bucket = q.bucket""")
LIQ = ("bar_vwap", "bar_open", "bar_high", "bar_low", "bar_close", *QUOTE, "last_trade_price", "bar_vwap_minus_avg_mid")


@query("foj_trade_quote_bars", f"SELECT symbol, bucket, bar_trade_count, quote_count, bar_volume, {rlist(*LIQ)} FROM liq")
def foj_trade_quote_bars(spark, d):
    return rounded(B.liquidity_bars(P.bars30_gap(spark, d), P.quotes30_gap(spark, d)), *LIQ)


# provider bars: every second 30-minute trade bar, slightly different prices
cte("provider", """SELECT symbol, bucket, bar_open, bar_high, bar_low, bar_close * 1.01 AS bar_close, CAST(bar_volume AS DOUBLE) AS bar_volume,
  bar_vwap, bar_trade_count FROM tb_half""")
cte("bl", """SELECT coalesce(p.symbol, q.symbol) AS symbol, coalesce(p.bucket, q.bucket) AS bucket,
  coalesce(p.bar_open, q.bar_open) AS bar_open, coalesce(p.bar_high, q.bar_high) AS bar_high, coalesce(p.bar_low, q.bar_low) AS bar_low,
  coalesce(p.bar_close, q.bar_close) AS bar_close, coalesce(p.bar_volume, q.bar_volume) AS bar_volume,
  coalesce(p.bar_vwap, q.bar_vwap) AS bar_vwap, coalesce(p.bar_trade_count, q.bar_trade_count) AS bar_trade_count, quote_count,
  avg_bid, avg_ask, avg_mid, avg_bid_size, avg_ask_size, avg_spread, last_bid, last_ask
  FROM provider p FULL OUTER JOIN liq q ON p.symbol = q.symbol AND p.bucket = q.bucket""")


def provider(spark, d):
    bars = P.trade_bars(P.late(P.trades(spark, d), 2), "30Min")
    return bars.select("symbol", "bucket", "bar_open", "bar_high", "bar_low", (F.col("bar_close") * 1.01).alias("bar_close"),
                       F.col("bar_volume").cast("double").alias("bar_volume"), "bar_vwap", "bar_trade_count")


SBAR = ("bar_open", "bar_high", "bar_low", "bar_close", "bar_volume", "bar_vwap", "avg_bid", "avg_ask", "avg_spread")


@query("foj_bar_liquidity", f"""
SELECT symbol, bucket, {rlist(*SBAR)}, bar_trade_count, quote_count, {rs('bar_close * bar_volume')} AS dollar_volume,
  {rs('CASE WHEN avg_mid <> 0 THEN avg_spread / avg_mid * 10000 END')} AS spread_bps FROM bl""")
def foj_bar_liquidity(spark, d):
    liq = B.liquidity_bars(P.bars30_gap(spark, d), P.quotes30_gap(spark, d))
    out = J.bars_with_liquidity(provider(spark, d), liq)
    return rounded(out, *SBAR, "dollar_volume", "spread_bps").select(
        "symbol", "bucket", *SBAR, "bar_trade_count", "quote_count", "dollar_volume", "spread_bps")


@query("source_strategy_bars", f"""
SELECT symbol, '30Min' AS timeframe, bucket AS timestamp, {rlist(*SBAR)}, bar_trade_count,
  {rs('bar_close * bar_volume')} AS dollar_volume, quote_count, {rlist('avg_bid_size', 'avg_ask_size', 'last_bid', 'last_ask')},
  {rs('CASE WHEN avg_mid <> 0 THEN avg_spread / avg_mid * 10000 END')} AS spread_bps FROM bl""")
def source_strategy_bars(spark, d):
    t, q = P.late(P.trades(spark, d), 5), P.late(P.quotes(spark, d), 7)
    out = strategy_bars(provider(spark, d), t, q, "30Min")
    return rounded(out, *SBAR, "dollar_volume", "avg_bid_size", "avg_ask_size", "last_bid", "last_ask", "spread_bps")


CRYPTO = ("bar_volume", "trade_notional", "bar_vwap", "bar_open", "bar_high", "bar_low", "bar_close")


@query("crypto_trade_bars", f"""
SELECT symbol, time_bucket(INTERVAL '5 minutes', ts) AS bucket, count(*) AS bar_trade_count,
  {rs('sum(size / 8.0)')} AS bar_volume, {rs('sum(price * size / 8.0)')} AS trade_notional,
  {rs('CASE WHEN sum(size) <> 0 THEN sum(price * size) / sum(size) END')} AS bar_vwap,
  {rs('arg_min(price, row(ts, seq))')} AS bar_open, {rs('max(price)')} AS bar_high, {rs('min(price)')} AS bar_low,
  {rs('arg_max(price, row(ts, seq))')} AS bar_close, CAST(NULL AS BIGINT) AS quote_count, CAST(NULL AS DOUBLE) AS avg_mid
FROM trades GROUP BY ALL""")
def crypto_trade_bars(spark, d):
    t = P.trades(spark, d).withColumn("size", F.col("size") / 8.0)
    out = rounded(B.crypto_trade_bars(t, "5Min"), *CRYPTO)
    return out.select("symbol", "bucket", "bar_trade_count", *CRYPTO, "quote_count", "avg_mid")


# one-second option rows: zero prices and empty rows are sprinkled in by size
cte("osec", """SELECT upper(symbol) AS underlying, '2024-02-16' AS expiration, CASE WHEN seq % 2 = 0 THEN 'CALL' ELSE 'PUT' END AS option_right_type,
  100.0 AS strike, ts, seq, CASE WHEN size % 5 = 0 THEN 0.0 ELSE price END AS open, CASE WHEN size % 6 = 0 THEN 0.0 ELSE price * 1.02 END AS high,
  CASE WHEN size % 7 = 0 THEN NULL ELSE price * 0.98 END AS low, CASE WHEN size % 3 = 0 THEN 0.0 ELSE price * 1.01 END AS close,
  CASE WHEN size % 11 = 0 THEN 0 ELSE size END AS volume, CASE WHEN size % 22 = 0 THEN 0 ELSE 1 END AS count, price AS vwap FROM trades""")


def option_seconds(spark, d):
    p, k = F.col("price"), F.col("size")
    zero = F.lit(0.0)
    return P.trades(spark, d).select(
        F.upper("symbol").alias("underlying"), F.lit("2024-02-16").alias("expiration"),
        F.when(F.col("seq") % 2 == 0, "CALL").otherwise("PUT").alias("option_right_type"), F.lit(100.0).alias("strike"), "ts", "seq",
        F.when(k % 5 == 0, zero).otherwise(p).alias("open"), F.when(k % 6 == 0, zero).otherwise(p * 1.02).alias("high"),
        F.when(k % 7 != 0, p * 0.98).alias("low"), F.when(k % 3 == 0, zero).otherwise(p * 1.01).alias("close"),
        F.when(k % 11 == 0, F.lit(0)).otherwise(k).alias("volume"), F.when(k % 22 == 0, F.lit(0)).otherwise(F.lit(1)).alias("count"),
        p.alias("vwap"))


OBAR = ("bar_open", "bar_high", "bar_low", "bar_close", "bar_vwap")


@query("option_bars", f"""
SELECT underlying, expiration, option_right_type, strike, time_bucket(INTERVAL '1 hour', ts) AS bucket,
  {rs('coalesce(arg_min(open, row(ts, seq)) FILTER (open <> 0), arg_min_null(open, row(ts, seq)))')} AS bar_open,
  {rs('coalesce(max(nullif(high, 0)), arg_min_null(high, row(ts, seq)))')} AS bar_high,
  {rs('coalesce(min(nullif(low, 0)), arg_min_null(low, row(ts, seq)))')} AS bar_low,
  {rs('coalesce(arg_max(close, row(ts, seq)) FILTER (close <> 0), arg_min_null(close, row(ts, seq)))')} AS bar_close,
  CAST(sum(volume) AS BIGINT) AS bar_volume, CAST(sum(count) AS BIGINT) AS bar_trade_count,
  {rs('CASE WHEN sum(volume) <> 0 THEN sum(CASE WHEN close <> 0 THEN close ELSE vwap END * volume) / sum(volume) END')} AS bar_vwap
FROM osec WHERE volume > 0 OR count > 0 GROUP BY ALL""")
def option_bars(spark, d):
    return rounded(B.option_bars(option_seconds(spark, d), "1Hour"), *OBAR)


@query("positive_activity_filter", f"""
SELECT underlying, option_right_type, seq, volume, CAST(count AS INTEGER) AS count, {rs('close')} AS close FROM osec WHERE volume > 0 OR count > 0""")
def positive_activity_filter(spark, d):
    out = B.active_ohlc(option_seconds(spark, d))
    return out.select("underlying", "option_right_type", "seq", "volume", "count", r("close").alias("close"))


@query("key_union", """
SELECT symbol, bucket FROM tb_gap UNION SELECT symbol, bucket FROM qb_gap""")
def key_union(spark, d):
    t = P.bars30_gap(spark, d).select("symbol", "bucket")
    return t.union(P.quotes30_gap(spark, d).select("symbol", "bucket")).distinct()


@query("liquidity_only_rows", f"""
SELECT q.symbol, q.bucket, q.quote_count, {rs('q.avg_mid')} AS avg_mid FROM liq q ANTI JOIN provider p ON p.symbol = q.symbol AND p.bucket = q.bucket""")
def liquidity_only_rows(spark, d):
    liq = B.liquidity_bars(P.bars30_gap(spark, d), P.quotes30_gap(spark, d))
    out = liq.join(provider(spark, d).select("symbol", "bucket"), ["symbol", "bucket"], "left_anti")
    return out.select("symbol", "bucket", "quote_count", r("avg_mid").alias("avg_mid"))
