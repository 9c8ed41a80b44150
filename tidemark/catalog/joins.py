"""Queries: as-of, tail, interval, lookup and set joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indicators as I, joins as J
from ..operators.epochs import epochs, pair_epochs, snapshot_grid
from ..plans import sources as S
from ..plans.features import PAIR_COLUMNS
from ..shared import staged
from . import proxies as P
from .registry import cte, query, r, rlist, rounded, rs

# every trade asks for the latest mark: marks lag behind in one hour of five and tie within their hour
cte("asks", "SELECT symbol, ts AS at, seq FROM trades")
cte("marks", "SELECT symbol, time_bucket(INTERVAL '1 hour', ts) AS avail, ts, price FROM trades_late")


def asks(spark, d):
    return P.trades(spark, d).select("symbol", F.col("ts").alias("at"), "seq")


def marks(spark, d):
    from ..functions.times import tumbling

    return tumbling(P.late(P.trades(spark, d), 5), "ts", "1Hour", "avail").select("symbol", "avail", "ts", "price")


@query("asof_latest_close", f"""
SELECT a.symbol, a.at, a.seq, {rs('m.price')} AS close FROM asks a ASOF LEFT JOIN
  (SELECT symbol, avail, arg_max(price, ts) AS price FROM marks GROUP BY ALL) m ON a.symbol = m.symbol AND a.at >= m.avail""")
def asof_latest_close(spark, d):
    out = J.asof_join(asks(spark, d), marks(spark, d), ["symbol"], "at", "avail", ["price"], tie=["ts"])
    return out.select("symbol", "at", "seq", r("price").alias("close"))


cte("usyms", "SELECT symbol FROM universe")
cte("seen", """SELECT s.snapshot_time, u.symbol, i.idx FROM snaps s CROSS JOIN usyms u
  ASOF LEFT JOIN ind i ON u.symbol = i.symbol AND s.snapshot_time >= i.avail""")


@query("asof_daily_history", f"""
SELECT snapshot_time, symbol, idx AS bars_visible, ts AS last_day, {rs('c')} AS last_close FROM seen JOIN ind USING (symbol, idx)""")
def asof_daily_history(spark, d):
    ind = I.daily_indicators(P.daily_bars(spark, d)).select("symbol", "ts", "available_time", "idx", "bar_close")
    vis = J.visible_rows(P.snapshots(spark, d), ind)
    return vis.select("snapshot_time", "symbol", F.col("idx").alias("bars_visible"), F.col("ts").alias("last_day"),
                      r("bar_close").alias("last_close"))


# spans of snapshots in which no leg of a pair changes
cte("ends", """SELECT p.*, n.idx AS n_num, m.idx AS n_den, n.idx - 1 AS r_num, m.idx - 1 AS r_den, a.vol20 AS num_vol, b.vol20 AS den_vol,
  min(n.snapshot_time) AS first_snapshot, max(n.snapshot_time) AS last_snapshot, count(*) AS n_snapshots
  FROM pairs p JOIN seen n ON n.symbol = p.numerator JOIN seen m ON m.symbol = p.denominator AND m.snapshot_time = n.snapshot_time
  LEFT JOIN ind a ON a.symbol = p.numerator AND a.idx = n.idx LEFT JOIN ind b ON b.symbol = p.denominator AND b.idx = m.idx GROUP BY ALL""")
cte("rt", """SELECT e.numerator, e.denominator, e.n_num, e.n_den, k, a.c / b.c AS ratio FROM
  (SELECT DISTINCT numerator, denominator, n_num, n_den, unnest(range(0, least(n_num, n_den, 220))) AS k FROM ends WHERE n_num IS NOT NULL AND n_den IS NOT NULL) e
  JOIN ind a ON a.symbol = e.numerator AND a.idx = e.n_num - e.k JOIN ind b ON b.symbol = e.denominator AND b.idx = e.n_den - e.k""")


def daily(spark, d, *columns, bars=None):
    """The grid of snapshots, wanted indicator columns of each daily bar, and their epochs by symbol."""
    grid = snapshot_grid(P.snapshots(spark, d))
    found = I.daily_indicators(P.daily_bars(spark, d) if bars is None else bars)
    ind = staged(found.select("symbol", "ts", "available_time", *columns), "indicators")
    return grid, ind, epochs(ind, grid, ["symbol"], list(columns), listed=P.universe(spark, d))


def ends(spark, d, *columns, bars=None):
    """The grid, indicators and pair epochs with the named columns of both legs."""
    grid, ind, seen = daily(spark, d, *columns, bars=bars)
    legs = [c for c in columns if c not in ("bar_close", "return_1d")]
    return grid, ind, staged(pair_epochs(seen, P.pairs(spark, d), PAIR_COLUMNS, legs, grid), "ends")


@query("tail_aligned_ratio", f"SELECT numerator, denominator, n_num, n_den, k, {rs('ratio')} AS ratio FROM rt")
def tail_aligned_ratio(spark, d):
    _, ind, e = ends(spark, d, "idx", "bad", "bar_close")
    out = I.ratio_tail(e, I.close_series(ind))
    return out.select("numerator", "denominator", "n_num", "n_den", "k", r("ratio").alias("ratio"))


@query("interval_join_positions", f"""
SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, {rs('l_quantity')} AS l_quantity, {rs('l_extendedprice')} AS l_extendedprice
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL '30 days' + INTERVAL '1 hour'""")
def interval_join_positions(spark, d):
    spans = P.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("entry"),
                                               (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(30))).alias("exit"))
    rows = P.table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    out = J.interval_join(rows, spans, ["o_orderkey"], "l_shipdate", "entry", "exit", F.make_dt_interval(hours=F.lit(1)))
    return out.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", r("l_quantity").alias("l_quantity"),
                      r("l_extendedprice").alias("l_extendedprice"))


@query("enrich_by_timestamp", f"""
SELECT t.symbol, t.bucket, {rs('t.bar_close')} AS bar_close, {rs('b.bench_close')} AS bench_close, {rs('q.avg_spread')} AS avg_spread
FROM tb t LEFT JOIN (SELECT bucket, arg_max(bar_close, row(bar_volume, bar_close)) AS bench_close FROM tb GROUP BY ALL) b
  ON b.bucket = t.bucket LEFT JOIN qb_gap q ON q.symbol = t.symbol AND q.bucket = t.bucket""")
def enrich_by_timestamp(spark, d):
    bars = P.bars30(spark, d)
    bench = bars.select(
        "bucket", F.col("bar_close").alias("bench_close"), "bar_volume")
    out = J.enrich(bars, bench, ["bucket"], ["bench_close"], order=["bar_volume", "bench_close"])
    out = J.enrich(out, P.quotes30_gap(spark, d), ["symbol", "bucket"], ["avg_spread"])
    return rounded(out, "bar_close", "bench_close", "avg_spread").select("symbol", "bucket", "bar_close", "bench_close", "avg_spread")


@query("lookup_universe", f"""
SELECT p_partkey, upper(p_brand) AS symbol, issuer_name, universe_type, exposure_type, bar_grain, {rs('p_retailprice')} AS p_retailprice
FROM part LEFT JOIN universe ON upper(p_brand) = symbol""")
def lookup_universe(spark, d):
    rows = P.table(spark, d, "part").select("p_partkey", F.upper("p_brand").alias("symbol"), r("p_retailprice").alias("p_retailprice"))
    return J.lookup(rows, P.universe(spark, d), ["symbol"], ["issuer_name", "universe_type", "exposure_type", "bar_grain"])


@query("pairwise_symbols", """
SELECT a.symbol AS left_symbol, b.symbol AS right_symbol FROM brands a JOIN brands b ON a.symbol < b.symbol""")
def pairwise_symbols(spark, d):
    return J.pairwise_symbols(P.universe(spark, d))


@query("snapshots_x_pairs", """
SELECT snapshot_time, combination_id AS rotation_pair_id, combination_type AS rotation_pair_type FROM snaps CROSS JOIN pairs
  WHERE combination_type IN ('sector_rotation', 'daily_context')
UNION ALL SELECT snapshot_time, 'sector_observation_breadth', 'sector_rotation_summary' FROM snaps""")
def snapshots_x_pairs(spark, d):
    snaps = P.snapshots(spark, d)
    own = P.pairs(spark, d).where(F.col("combination_type") != "primary").select(
        F.col("combination_id").alias("rotation_pair_id"), F.col("combination_type").alias("rotation_pair_type"))
    rows = J.with_each(snaps, own, ["rotation_pair_id", "rotation_pair_type"])
    summary = snaps.withColumns({"rotation_pair_id": F.lit("sector_observation_breadth"), "rotation_pair_type": F.lit("sector_rotation_summary")})
    return rows.unionByName(summary)


# option chain in three copies of part whose strikes differ in places, with duplicate arrivals
cte("chq", """SELECT p_partkey, p_brand AS symbol, CAST(DATE '1999-01-01' + p_size AS VARCHAR) AS expiration, CAST(p_partkey + CASE WHEN p_partkey % 2 = 0 THEN 0.0 ELSE 0.25 END AS DOUBLE) AS strike,
  CASE WHEN p_partkey % 4 < 2 THEN 'CALL' ELSE 'PUT' END AS right_, p_retailprice AS bid, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_retailprice + p_size END AS ask,
  p_size AS bid_size FROM part""")
cte("chi", """SELECT p_partkey, p_brand AS symbol, CAST(DATE '1999-01-01' + p_size AS VARCHAR) AS expiration, CAST(p_partkey + CASE WHEN p_partkey % 3 = 0 THEN 0.0 ELSE 0.5 END AS DOUBLE) AS strike,
  CASE WHEN p_partkey % 4 < 2 THEN 'CALL' ELSE 'PUT' END AS right_, p_size / 100.0 AS implied_vol, p_retailprice AS underlying_price FROM part""")
cte("chg", """SELECT p_partkey, p_brand AS symbol, CAST(DATE '1999-01-01' + p_size AS VARCHAR) AS expiration, CAST(p_partkey + CASE WHEN p_partkey % 5 = 0 THEN 0.0 ELSE 0.5 END AS DOUBLE) AS strike,
  CASE WHEN p_partkey % 4 < 2 THEN 'CALL' ELSE 'PUT' END AS right_, p_size / 50.0 AS delta, p_retailprice + 1 AS underlying_price FROM part""")
cte("chain", """SELECT upper(symbol) AS symbol, expiration, strike, right_ AS option_right_type, bid, ask, (bid + ask) / 2 AS mid, ask - bid AS spread,
  (ask - bid) / ((bid + ask) / 2) AS spread_pct, CAST(bid_size AS DOUBLE) AS bid_size, implied_vol, delta,
  CASE WHEN g.p_partkey IS NOT NULL THEN g.underlying_price ELSE i.underlying_price END AS underlying_price,
  CAST(expiration AS DATE) - DATE '1999-01-10' AS days_to_expiration
  FROM chq q FULL OUTER JOIN chi i USING (symbol, expiration, strike, right_) FULL OUTER JOIN chg g USING (symbol, expiration, strike, right_)
  WHERE CAST(expiration AS DATE) - DATE '1999-01-10' >= 0""")
SNAP = "1999-01-10 09:30:00"


def chain_inputs(spark, d):
    part = P.table(spark, d, "part")
    k = F.col("p_partkey")
    key = [F.col("p_brand").alias("symbol"), F.date_add(F.lit("1999-01-01").cast("date"), F.col("p_size")).cast("string").alias("expiration"),
           F.when(k % 4 < 2, "CALL").otherwise("PUT").alias("option_right_type")]
    stamp = F.lit("1999-01-10 09:29:59").cast("timestamp_ntz").alias("underlying_timestamp")

    def twice(df, *stale):
        # an older arrival of every contract with other values must lose
        old = df.withColumns({"arrival": F.col("arrival") - 1_000_000_000, **{c: F.lit(-1).cast(df.schema[c].dataType) for c in stale}})
        return df.unionByName(old)

    def strike(n, step):
        return (k + F.when(k % n == 0, 0.0).otherwise(step)).alias("strike")

    q = part.select(*key, strike(2, 0.25), k.alias("arrival"), F.col("p_retailprice").alias("bid"),
                                      F.when(F.col("p_size") % 9 != 0, F.col("p_retailprice") + F.col("p_size")).alias("ask"), F.col("p_size").alias("bid_size"))
    i = part.select(*key, strike(3, 0.5), k.alias("arrival"), (F.col("p_size") / 100.0).alias("implied_vol"), F.lit(0.0).alias("iv_error"),
                                      F.col("p_retailprice").alias("underlying_price"), stamp)
    g = part.select(*key, strike(5, 0.5), k.alias("arrival"), (F.col("p_size") / 50.0).alias("delta"),
                                      (F.col("p_retailprice") + 1).alias("underlying_price"), stamp)
    return twice(q, "bid", "ask"), twice(i, "implied_vol"), twice(g, "delta")


def chain(spark, d):
    return J.chain_rows(*chain_inputs(spark, d), F.lit(SNAP).cast("timestamp_ntz"))


CH = ("bid", "ask", "mid", "spread", "spread_pct", "bid_size", "implied_vol", "delta", "underlying_price")


@query("foj_chain_3way", f"SELECT symbol, expiration, strike, option_right_type, {rlist(*CH)}, days_to_expiration FROM chain")
def foj_chain_3way(spark, d):
    out = chain(spark, d).select("symbol", "expiration", "strike", "option_right_type", "quote.*", "iv.implied_vol", "greeks.delta",
                                 "underlying_context.underlying_price", "derived.days_to_expiration")
    return rounded(out, *CH)


@query("option_envelope", f"SELECT symbol, expiration, strike, option_right_type, {rlist(*CH)}, days_to_expiration FROM chain")
def option_envelope(spark, d):
    """The same chain from provider files, one for each contract and arrival."""
    from ..operators.nested import option_rows

    def files(df):
        values = [c for c in df.columns if c not in (*J.CHAIN_KEY, "arrival")]
        contract = F.struct(F.lower("symbol").alias("symbol"), "expiration", F.lower("option_right_type").alias("right"), "strike").alias("contract")
        late = F.struct(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in values])
        body = F.to_json(F.struct(F.array(F.struct(contract, F.array(F.struct(*values), late).alias("data"))).alias("response")))
        element = ", ".join(f"{c}: {df.schema[c].dataType.simpleString()}" for c in values)
        return option_rows(df.select(F.col("arrival").alias("seq"), body.alias("body")), element, first_only=True)

    out = J.chain_rows(*map(files, chain_inputs(spark, d)), F.lit(SNAP).cast("timestamp_ntz"))
    out = out.select("symbol", "expiration", "strike", "option_right_type", "quote.*", "iv.implied_vol", "greeks.delta",
                     "underlying_context.underlying_price", "derived.days_to_expiration")
    return rounded(out, *CH)


@query("unexpired_filter", """
SELECT p_partkey, CAST(DATE '1999-01-01' + p_size AS VARCHAR) AS expiration, p_size - 9 AS days_to_expiration FROM part WHERE p_size - 9 >= 0""")
def unexpired_filter(spark, d):
    from ..functions.times import days_to_expiration

    exp = F.date_add(F.lit("1999-01-01").cast("date"), F.col("p_size")).cast("string")
    dte = days_to_expiration(F.col("expiration"), F.lit(SNAP).cast("timestamp_ntz"))
    rows = P.table(spark, d, "part").select("p_partkey", exp.alias("expiration")).withColumn("days_to_expiration", dte)
    return rows.where(F.col("days_to_expiration").isNull() | (F.col("days_to_expiration") >= 0))


@query("chain_flatten", f"""
SELECT symbol AS underlying, TIMESTAMP '{SNAP}' AS snapshot_time, 'entry' AS snapshot_type,
  symbol || '_' || expiration || '_' || option_right_type[1] || '_' || CASE WHEN strike = floor(strike) THEN CAST(CAST(strike AS BIGINT) AS VARCHAR) ELSE CAST(CAST(strike AS DOUBLE) AS VARCHAR) END AS option_symbol,
  expiration, option_right_type, strike, {rlist(*CH)}, days_to_expiration FROM chain""")
def chain_flatten(spark, d):
    from ..operators.nested import flatten_contracts

    out = flatten_contracts(chain(spark, d), F.col("symbol"), F.lit(SNAP).cast("timestamp_ntz"))
    return rounded(out, *CH).select("underlying", "snapshot_time", "snapshot_type", "option_symbol", "expiration", "option_right_type",
                                    "strike", *CH, "days_to_expiration")


# positions: orders hold one instrument each, bars are their line items
@query("source_position_bars", f"""
SELECT 'O' || (o_orderkey % 100) AS underlying, 'C' || o_orderkey AS option_symbol, '2002-01-18' AS expiration,
  CASE WHEN o_orderkey % 2 = 0 THEN 'CALL' ELSE 'PUT' END AS option_right_type, CAST(o_orderkey % 500 AS DOUBLE) AS strike, '1Day' AS timeframe,
  l_shipdate AS timestamp, {rs('l_extendedprice')} AS bar_close, {rs('l_quantity')} AS bar_volume, CAST(l_linenumber AS BIGINT) AS bar_trade_count, l_partkey, l_suppkey
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL '30 days' + INTERVAL '1 hour'""")
def source_position_bars(spark, d):
    k = F.col("o_orderkey")
    contracts = P.table(spark, d, "orders").select(
        F.concat(F.lit("o"), k % 100).alias("underlying"), F.concat(F.lit("c"), k).alias("option_symbol"), F.lit("2002-01-18").alias("expiration"),
        F.when(k % 2 == 0, "c").otherwise("Put").alias("option_right_type"), (k % 500).alias("strike"),
        F.col("o_orderdate").alias("entry_time"), (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(30))).alias("exit_time"))
    rows = P.table(spark, d, "lineitem").select(
        F.concat(F.lit("C"), "l_orderkey").alias("option_symbol"), F.lit("1Day").alias("timeframe"), F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("close"), F.col("l_quantity").alias("volume"), F.col("l_linenumber").alias("count"), "l_partkey", "l_suppkey")
    out = S.position_bars(rows, contracts, extra=["l_partkey", "l_suppkey"])
    return rounded(out, "bar_close", "bar_volume").select(
        "underlying", "option_symbol", "expiration", "option_right_type", "strike", "timeframe", "timestamp", "bar_close", "bar_volume",
        "bar_trade_count", "l_partkey", "l_suppkey")


MARKET = ("bar_open", "bar_high", "bar_low", "bar_close")


@query("source_market_bars", f"""
SELECT d.symbol, CASE WHEN bar_grain = '1d' THEN '1Day' ELSE '30Min' END AS timeframe, ts, {rs('o')} AS bar_open, {rs('h')} AS bar_high, {rs('l')} AS bar_low,
  {rs('c')} AS bar_close, v AS bar_volume FROM daily d JOIN universe u ON u.symbol = d.symbol""")
def source_market_bars(spark, d):
    # a stale copy of every reviewed row must lose
    now = P.universe(spark, d).withColumn("seq", F.lit(2))
    stale = now.withColumns({"bar_grain": F.lit("5m"), "seq": F.lit(1)})
    out = S.market_bars(P.daily_bars(spark, d), now.unionByName(stale), ["seq"])
    return rounded(out, *MARKET).select("symbol", "timeframe", "ts", *MARKET, "bar_volume")


@query("field_alias_fallback", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rs('coalesce(CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice END, l_quantity)')} AS bar_close,
  CAST(coalesce(CASE WHEN l_linenumber % 3 = 0 THEN l_partkey END, CASE WHEN l_linenumber % 3 = 1 THEN l_suppkey END, l_orderkey) AS BIGINT) AS bar_trade_count FROM lineitem""")
def field_alias_fallback(spark, d):
    n = F.col("l_linenumber")
    rows = P.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(n % 2 == 0, F.col("l_extendedprice")).alias("bar_close"), F.col("l_quantity").alias("close"),
        F.when(n % 3 == 0, F.col("l_partkey")).alias("bar_trade_count"), F.when(n % 3 == 1, F.col("l_suppkey")).alias("trade_count"), F.col("l_orderkey").alias("count"))
    fields = S.field_aliases(rows)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(fields["bar_close"]).alias("bar_close"), fields["bar_trade_count"].alias("bar_trade_count"))


@query("symbol_intersect", "SELECT DISTINCT upper(p_brand) AS symbol FROM part INTERSECT SELECT DISTINCT 'BRAND#' || n_nationkey FROM nation")
def symbol_intersect(spark, d):
    want = P.table(spark, d, "nation").select(F.concat(F.lit("BRAND#"), "n_nationkey").alias("symbol"))
    return P.universe(spark, d).select("symbol").intersect(want)


@query("union_rows", f"""
SELECT symbol, ts, {rs('c')} AS bar_close, CAST(NULL AS BIGINT) AS bar_trade_count FROM daily
UNION ALL SELECT symbol, bucket, {rs('bar_close')}, bar_trade_count FROM tb""")
def union_rows(spark, d):
    a = P.daily_bars(spark, d).select("symbol", "ts", r("bar_close").alias("bar_close"))
    b = P.bars30(spark, d).select("symbol", F.col("bucket").alias("ts"), r("bar_close").alias("bar_close"), "bar_trade_count")
    return a.unionByName(b, allowMissingColumns=True)
