"""Tick aggregation, pinned numbers."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.times import iso_et, parse_ts_et
from tidemark.operators.bars import active_ohlc, crypto_trade_bars, liquidity_bars, option_bars, quote_bars, trade_bars
from tidemark.operators.nested import normalize_candles, normalize_crypto_trades, normalize_equity_bars
from tidemark.plans.sources import strategy_bars
from tidemark.streaming.bars import stream_trade_bars


def ticks(spark, rows, cols):
    df = spark.createDataFrame(rows, f"symbol string, t string, seq int, {cols}")
    return df.withColumn("ts", parse_ts_et(F.col("t")))


TRADES = [("AAPL", "2024-01-02T14:30:01Z", 1, 10.0, 2), ("AAPL", "2024-01-02T14:30:30Z", 2, 12.0, 3)]


def test_trades_in_one_minute(spark):
    row = trade_bars(ticks(spark, TRADES, "price double, size int"), "1Min").withColumn("at", iso_et(F.col("bucket"))).first()
    assert (row["at"], row.bar_trade_count, row.bar_volume, row.bar_vwap) == ("2024-01-02T09:30:00-05:00", 2, 5, 11.2)
    assert (row.bar_open, row.bar_high, row.bar_low, row.bar_close, row.trade_notional) == (10.0, 12.0, 10.0, 12.0, 56.0)


def test_quotes_and_mid(spark):
    rows = [("AAPL", "2024-01-02T14:30:02Z", 1, 10.0, 10.5, 2, 1), ("AAPL", "2024-01-02T14:30:20Z", 2, 10.5, 12.0, 3, 4)]
    q = quote_bars(ticks(spark, rows, "bid double, ask double, bid_size int, ask_size int"), "1Min").first()
    assert (q.quote_count, q.avg_mid, q.avg_spread, q.avg_bid_size) == (2, 10.75, 1.0, 2.5)


def test_one_sided_quote_counts_in_mid_but_not_in_spread(spark):
    rows = [("A", "2024-01-02T14:30:02Z", 1, 10.0, 12.0, 1, 1), ("A", "2024-01-02T14:30:20Z", 2, 10.0, None, 1, 1)]
    q = quote_bars(ticks(spark, rows, "bid double, ask double, bid_size int, ask_size int"), "1Min").first()
    assert (q.avg_mid, q.avg_spread, q.avg_ask, q.last_mid) == (5.5, 2.0, 6.0, None)


def test_trade_inside_quote(spark):
    t = ticks(spark, [("A", "2024-01-02T14:30:01Z", 1, 11.0, 1)], "price double, size int")
    q = ticks(spark, [("A", "2024-01-02T14:30:01Z", 1, 10.0, 12.0, 1, 1)], "bid double, ask double, bid_size int, ask_size int")
    row = liquidity_bars(trade_bars(t, "1Min"), quote_bars(q, "1Min")).first()
    assert row.bar_vwap_minus_avg_mid == 0.0


def test_outer_sides_keep_zero_counts(spark):
    t = ticks(spark, [("A", "2024-01-02T14:30:01Z", 1, 11.0, 1)], "price double, size int")
    q = ticks(spark, [("A", "2024-01-02T14:31:01Z", 1, 10.0, 12.0, 1, 1)], "bid double, ask double, bid_size int, ask_size int")
    rows = liquidity_bars(trade_bars(t, "1Min"), quote_bars(q, "1Min")).orderBy("bucket").collect()
    assert [(r.bar_trade_count, r.quote_count) for r in rows] == [(1, 0), (0, 1)]


def test_strategy_row(spark):
    bars = spark.createDataFrame([("NVDA", datetime(2026, 4, 24, 9, 30), 1000.0, 100.5)], "symbol string, bucket timestamp_ntz, bar_volume double, bar_close double")
    bars = bars.withColumns({c: F.lit(100.0) for c in ("bar_open", "bar_high", "bar_low", "bar_vwap")}).withColumn("bar_trade_count", F.lit(1).cast("bigint"))
    t = ticks(spark, [("NVDA", "2026-04-24T13:30:01Z", 1, 100.5, 10)], "price double, size int")
    q = ticks(spark, [("NVDA", "2026-04-24T13:30:01Z", 1, 100.45, 100.65, 1, 1)], "bid double, ask double, bid_size int, ask_size int")
    row = strategy_bars(bars, t, q).first()
    assert row.dollar_volume == 100500.0 and abs(row.avg_spread - 0.2) < 1e-9
    assert abs(row.spread_bps - 19.890601690701146) < 1e-6 and row.timestamp == datetime(2026, 4, 24, 9, 30)


def test_option_bars(spark):
    body = [
        ("2026-04-24T09:30:00.000", 0.0, 0.0, 0.0, 0.0, 0, 0, 0.0),
        ("2026-04-24T09:30:02.000", 10.0, 10.0, 10.0, 10.0, 1, 1, 10.0),
        ("2026-04-24T09:30:30.000", 9.0, 9.2, 8.9, 9.0, 2, 2, 9.3),
        ("2026-04-24T09:31:01.000", 8.0, 8.5, 8.0, 8.2, 1, 1, 8.2),
    ]
    df = spark.createDataFrame(body, "t string, open double, high double, low double, close double, volume int, count int, vwap double")
    df = df.withColumns({"ts": parse_ts_et(F.col("t")), "seq": F.lit(1), "c": F.lit("AAPL")})
    assert active_ohlc(df).count() == 3
    rows = option_bars(df, "1Min", keys=["c"]).orderBy("bucket").collect()
    a = rows[0]
    assert len(rows) == 2
    assert (a.bar_open, a.bar_high, a.bar_low, a.bar_close, a.bar_volume, a.bar_trade_count, a.bar_vwap) == (10.0, 10.0, 8.9, 9.0, 3, 3, 9.3333333333)


def test_option_bar_keeps_zero_when_nothing_follows(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 2, 10), 1, 0.0, None, 0.0, 0.0, 5, 1, 7.0)],
                               "c string, ts timestamp_ntz, seq int, open double, high double, low double, close double, volume int, count int, vwap double")
    row = option_bars(df, "1Min", keys=["c"]).first()
    assert (row.bar_open, row.bar_high, row.bar_close, row.bar_vwap) == (0.0, None, 0.0, 7.0)


def test_crypto(spark):
    candle = spark.createDataFrame([("BTC-USDT", "1Min", ["1777241580000", "1", "2", "0.5", "1.5", "3", "0", "0", "1"])], "symbol string, timeframe string, candle array<string>")
    row = normalize_candles(candle).withColumn("at", iso_et(F.col("ts"))).first()
    assert row["at"] == "2026-04-26T18:13:00-04:00" and row.bar_vwap is None
    raw = spark.createDataFrame([("btc-usdt", "buy", "0.5", "2", "7", "1777241580000")], "instId string, side string, sz string, px string, tradeId string, ts string")
    trade = normalize_crypto_trades(raw)
    assert trade.first().notional == 1.0
    bar = crypto_trade_bars(trade.withColumn("seq", F.col("trade_id")), "1Min").first()
    assert (bar.bar_volume, bar.bar_vwap, bar.quote_count, bar.avg_bid) == (0.5, 2.0, None, None)


def test_daily_bar_time(spark):
    raw = spark.createDataFrame([("spy", "1d", "2024-01-02T05:00:00Z", 1.0)], "symbol string, timeframe string, t string, c double")
    raw = raw.withColumns({k: F.lit(1.0) for k in ("o", "h", "l", "v", "vw", "n")})
    row = normalize_equity_bars(raw).withColumn("at", iso_et(F.col("ts"))).first()
    assert (row["at"], row.timeframe, row.symbol) == ("2024-01-02T00:00:00-05:00", "1Day", "SPY")


def test_autumn_hour_collapses_into_one_bucket(spark):
    rows = [("A", "2024-11-03T05:30:00Z", 1, 1.0, 1), ("A", "2024-11-03T06:30:00Z", 2, 2.0, 1)]
    out = trade_bars(ticks(spark, rows, "price double, size int"), "1Hour").collect()
    assert len(out) == 1 and out[0].bar_trade_count == 2


def test_empty_input(spark):
    empty = ticks(spark, [], "price double, size int")
    assert trade_bars(empty).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    df = ticks(spark, TRADES + [("AAPL", "2024-01-02T18:30:30Z", 3, 13.0, 1), ("AAPL", "2024-01-03T18:30:30Z", 4, 13.0, 1)], "price double, size int").drop("t")
    df.write.parquet(str(src))
    stream = spark.readStream.schema(df.schema).parquet(str(src))
    q = stream_trade_bars(stream).writeStream.format("memory").queryName("bars_out").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.table("bars_out").collect()}
    want = {tuple(r) for r in trade_bars(df).collect()}
    assert got and got <= want
