"""Market-shaped views of the test tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.bars import quote_bars, trade_bars
from ..operators.indicators import prepare_bars
from ..plans.features import infer_snapshots
from .registry import cte


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def landed(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    """A table whose rows stand for landed documents, dealt by key: one file's rows are documents that all cores should parse."""
    return table(spark, d, name).repartition(key)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# ------------------------------------------------------------------ ticks

cte("trades", """SELECT event_type AS symbol, ts, event_id AS seq, value AS price,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS size FROM events""")


def trades(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("seq"), F.col("value").alias("price"), _k().alias("size")
    )


cte("quotes", """SELECT symbol, ts, seq, price AS bid, CASE WHEN size % 7 = 0 THEN NULL ELSE price + size / 100.0 END AS ask,
  size AS bid_size, size + 1 AS ask_size FROM trades""")


def quotes(spark: SparkSession, d: str) -> DataFrame:
    ask = F.when(F.col("size") % 7 != 0, F.col("price") + F.col("size") / 100.0)
    return trades(spark, d).select("symbol", "ts", "seq", F.col("price").alias("bid"), ask.alias("ask"),
                                   F.col("size").alias("bid_size"), (F.col("size") + 1).alias("ask_size"))


def late_sql(name: str, n: int) -> str:
    return f"""SELECT * REPLACE (CASE WHEN hour(ts) % {n} = 0 THEN ts + INTERVAL '40 days' ELSE ts END AS ts) FROM {name}"""


def late(df: DataFrame, n: int) -> DataFrame:
    """The same ticks with every n-th hour 40 days later: streams with different gaps, no row left out."""
    return df.withColumn("ts", F.when(F.hour("ts") % n == 0, F.col("ts") + F.make_dt_interval(days=F.lit(40))).otherwise(F.col("ts")))


cte("trades_late", late_sql("trades", 5))
cte("trades_half", late_sql("trades", 2))

TB = """SELECT symbol, time_bucket(INTERVAL '30 minutes', ts) AS bucket, count(*) AS bar_trade_count,
  CAST(sum(size) AS BIGINT) AS bar_volume, sum(price * size) AS notional, arg_min(price, row(ts, seq)) AS bar_open,
  max(price) AS bar_high, min(price) AS bar_low, arg_max(price, row(ts, seq)) AS bar_close,
  min(ts) AS first_trade_ts, max(ts) AS last_trade_ts,
  CASE WHEN sum(size) <> 0 THEN round(sum(price * size) / sum(size), 10) END AS bar_vwap
  FROM {source} GROUP BY ALL"""
cte("tb", TB.format(source="trades"))
cte("tb_gap", TB.format(source="trades_late"))
cte("tb_half", TB.format(source="trades_half"))

cte("qt", """SELECT symbol, ts, seq, coalesce(bid, 0.0) AS bid, coalesce(ask, 0.0) AS ask, bid_size, ask_size,
  CASE WHEN coalesce(bid, 0) <> 0 AND coalesce(ask, 0) <> 0 THEN (ask + bid) / 2 END AS mid,
  CASE WHEN coalesce(bid, 0) <> 0 AND coalesce(ask, 0) <> 0 THEN ask - bid END AS spread FROM quotes""")

cte("qt_late", late_sql("qt", 7))
QB = """SELECT symbol, time_bucket(INTERVAL '30 minutes', ts) AS bucket, count(*) AS quote_count,
  round(sum(bid) / count(*), 10) AS avg_bid, round(sum(ask) / count(*), 10) AS avg_ask,
  round(coalesce(sum(mid), 0) / count(*), 10) AS avg_mid, round(sum(spread) / count(spread), 10) AS avg_spread, min(spread) AS min_spread, max(spread) AS max_spread,
  sum(bid_size) / count(*) AS avg_bid_size, sum(ask_size) / count(*) AS avg_ask_size,
  arg_max(bid, row(ts, seq)) AS last_bid, arg_max(ask, row(ts, seq)) AS last_ask,
  arg_max_null(mid, row(ts, seq)) AS last_mid, min(ts) AS first_quote_ts, max(ts) AS last_quote_ts
  FROM {source} GROUP BY ALL"""
cte("qb", QB.format(source="qt"))
cte("qb_gap", QB.format(source="qt_late"))


def bars30(spark: SparkSession, d: str) -> DataFrame:
    return trade_bars(trades(spark, d), "30Min")


def quotes30(spark: SparkSession, d: str) -> DataFrame:
    return quote_bars(quotes(spark, d), "30Min")


def bars30_gap(spark: SparkSession, d: str) -> DataFrame:
    return trade_bars(late(trades(spark, d), 5), "30Min")


def quotes30_gap(spark: SparkSession, d: str) -> DataFrame:
    return quote_bars(late(quotes(spark, d), 7), "30Min")


# ------------------------------------------------------------------ daily bars

cte("daily", """SELECT upper(p_brand) AS symbol, l_shipdate AS ts, l_shipdate + INTERVAL '16 hours' AS avail,
  arg_min(price, k) AS o, max(price) AS h, min(price) AS l, arg_max(price, k) AS c, CAST(sum(l_quantity) AS BIGINT) AS v
  FROM (SELECT p_brand, l_shipdate, l_quantity, l_extendedprice / l_quantity AS price,
        row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / l_quantity) AS k
        FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY ALL""")


def daily_bars(spark: SparkSession, d: str) -> DataFrame:
    """Brand-day bars with the time they become visible."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    part = table(spark, d, "part").select("p_partkey", F.upper("p_brand").alias("symbol"))
    ticks = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "symbol", F.col("l_shipdate").alias("ts"), price.alias("price"), F.col("l_quantity").alias("size"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", price.alias("price")).alias("seq"),
    )
    bars = trade_bars(ticks, "1Day").select(
        "symbol", F.lit("1Day").alias("timeframe"), F.col("bucket").alias("ts"), "bar_open", "bar_high", "bar_low",
        "bar_close", "bar_volume",
    )
    return prepare_bars(bars)


# ------------------------------------------------------------------ reviewed lists

cte("brands", """SELECT DISTINCT upper(p_brand) AS symbol, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n FROM part""")
cte("universe", """SELECT symbol, n, CASE WHEN n <= 10 THEN 'market_state_etf' ELSE 'sector_observation_etf' END AS universe_type,
  CASE WHEN n % 2 = 0 THEN 'core' ELSE 'theme' END AS exposure_type, CASE WHEN n % 2 = 0 THEN '1d' ELSE '30m' END AS bar_grain,
  'Issuer ' || (n % 4) AS issuer_name FROM brands""")
cte("pairs", """SELECT 'b' || a.n || '_b' || b.n AS combination_id,
  CASE a.n % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'sector_rotation' ELSE 'daily_context' END AS combination_type,
  a.symbol AS numerator, b.symbol AS denominator, CASE WHEN a.n % 2 = 0 THEN '30m' ELSE '1d' END AS feature_bar_grain
  FROM brands a JOIN brands b ON b.n = a.n + 1""")
cte("snaps", """SELECT CAST(day AS TIMESTAMP) + to_minutes(CAST(600 + 30 * i AS INTEGER)) AS snapshot_time
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem), range(13) h(i)""")


def universe(spark: SparkSession, d: str) -> DataFrame:
    n = F.split("p_brand", "#")[1].cast("int")
    return table(spark, d, "part").select("p_brand").distinct().select(
        F.upper("p_brand").alias("symbol"),
        n.alias("n"),
        F.when(n <= 10, "market_state_etf").otherwise("sector_observation_etf").alias("universe_type"),
        F.when(n % 2 == 0, "core").otherwise("theme").alias("exposure_type"),
        F.when(n % 2 == 0, "1d").otherwise("30m").alias("bar_grain"),
        F.concat(F.lit("Issuer "), n % 4).alias("issuer_name"),
    )


def pairs(spark: SparkSession, d: str) -> DataFrame:
    u = universe(spark, d).select("symbol", "n")
    nxt = u.select(F.col("symbol").alias("denominator"), (F.col("n") - 1).alias("n"))
    n = F.col("n")
    return u.join(nxt, "n").select(
        F.concat(F.lit("b"), n, F.lit("_b"), n + 1).alias("combination_id"),
        F.when(n % 3 == 0, "primary").when(n % 3 == 1, "sector_rotation").otherwise("daily_context").alias("combination_type"),
        F.col("symbol").alias("numerator"),
        "denominator",
        F.when(n % 2 == 0, "30m").otherwise("1d").alias("feature_bar_grain"),
    )


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Every half hour after 09:30 up to 16:00 of every trading day, inferred from an anchor's half-hour bars."""
    days = table(spark, d, "lineitem").select(F.to_date("l_shipdate").cast("timestamp_ntz").alias("day")).distinct()
    minutes = F.explode(F.sequence(F.lit(9 * 60), F.lit(17 * 60), F.lit(30))).alias("minutes")
    at = F.timestamp_add("MINUTE", F.col("minutes"), F.col("day")).alias("available_time")
    return infer_snapshots(days.select("day", minutes).select(F.lit("ANCHOR").alias("symbol"), F.lit("30Min").alias("timeframe"), at), "ANCHOR")


# ------------------------------------------------------------------ articles

cte("articles", """SELECT page_id, 'a' || page_id AS article_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS source_domain,
  html AS themes, CASE WHEN page_id % 4 = 0 THEN '1#United States#US#' ELSE '4#Paris#FR#' END AS locations,
  DATE '2024-01-01' + CAST(page_id % 30 AS INTEGER) AS partition_date,
  TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (page_id * 7 % 720) AS article_time FROM pages""")


def articles(spark: SparkSession, d: str) -> DataFrame:
    pid = F.col("page_id")
    return table(spark, d, "pages").select(
        "page_id",
        F.concat(F.lit("a"), pid).alias("article_id"),
        "url",
        F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("source_domain"),
        F.col("html").alias("themes"),
        F.when(pid % 4 == 0, "1#United States#US#").otherwise("4#Paris#FR#").alias("locations"),
        F.date_add(F.lit("2024-01-01").cast("date"), (pid % 30).cast("int")).alias("partition_date"),
        F.timestamp_add("HOUR", pid * 7 % 720, F.lit("2024-01-01").cast("timestamp_ntz")).alias("article_time"),
    )
