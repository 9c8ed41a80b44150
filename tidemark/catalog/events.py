"""Queries: event detection and windowed activity."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import quotes as Q, symbols as Y, times as T
from ..functions.numbers import fmt6
from ..operators import events as E, quality as K
from . import proxies as P
from .registry import cte, query, r, rlist, rounded, rs

# ------------------------------------------------------------------ equity

cte("ebars", "SELECT symbol, '30Min' AS timeframe, bucket AS ts, bar_open, bar_close, CAST(bar_volume AS DOUBLE) AS bar_volume FROM tb")
cte("ebench", "SELECT bucket AS ts, bar_close / lag(bar_close) OVER (ORDER BY bucket) - 1 AS benchmark_ret FROM tb WHERE symbol = 'view'")
cte("eret", """SELECT b.*, lag(bar_close) OVER w AS prev_close, bar_close / nullif(lag(bar_close) OVER w, 0) - 1 AS ret,
  bar_open / nullif(lag(bar_close) OVER w, 0) - 1 AS gap FROM ebars b WINDOW w AS (PARTITION BY symbol ORDER BY ts)""")
cte("emeas", """SELECT e.*, benchmark_ret, ret - benchmark_ret AS relative, q.avg_spread AS spread, q.symbol IS NOT NULL AS has_liquidity
  FROM eret e LEFT JOIN ebench b ON b.ts = e.ts LEFT JOIN qb_gap q ON q.symbol = e.symbol AND q.bucket = e.ts""")
cte("ez", """SELECT symbol, ts, metric, CASE WHEN count(*) OVER w = 20 THEN (value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0) END AS z FROM (
  SELECT symbol, ts, 'ret' AS metric, ret AS value FROM emeas UNION ALL SELECT symbol, ts, 'volume', bar_volume FROM emeas
  UNION ALL SELECT symbol, ts, 'relative', relative FROM emeas UNION ALL SELECT symbol, ts, 'spread', spread FROM emeas)
  WHERE value IS NOT NULL WINDOW w AS (PARTITION BY symbol, metric ORDER BY ts ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""")
cte("escore", """SELECT m.*, max(z) FILTER (metric = 'ret') AS ret_z, max(z) FILTER (metric = 'volume') AS volume_z, max(z) FILTER (metric = 'relative') AS relative_z,
  max(z) FILTER (metric = 'spread') AS spread_z FROM emeas m LEFT JOIN ez USING (symbol, ts) GROUP BY ALL""")
GAP = E.EQUITY_DEFAULTS["min_abs_gap_pct"]


def ebars(spark, d):
    return P.bars30(spark, d).select(
        "symbol", F.lit("30Min").alias("timeframe"), F.col("bucket").alias("ts"), "bar_open", "bar_close", "bar_volume")


def ebench(spark, d):
    return P.bars30(spark, d).where(F.col("symbol") == "view").select(F.col("bucket").alias("ts"), "bar_close")


def eliq(spark, d):
    return P.quotes30_gap(spark, d).select("symbol", F.col("bucket").alias("ts"), "avg_spread")


@query("simple_return_gap", f"SELECT symbol, ts, {rlist('prev_close', 'ret', 'gap')} FROM eret")
def simple_return_gap(spark, d):
    return rounded(E.simple_returns(ebars(spark, d)), "prev_close", "ret", "gap").select("symbol", "ts", "prev_close", "ret", "gap")


@query("relative_return", f"SELECT symbol, ts, {rlist('benchmark_ret', 'relative')} FROM emeas")
def relative_return(spark, d):
    out = E.equity_measures(ebars(spark, d), ebench(spark, d), eliq(spark, d))
    return out.select("symbol", "ts", r("benchmark_ret").alias("benchmark_ret"), r("relative").alias("relative"))


@query("trailing_zscore", f"SELECT symbol, ts, {rlist('ret_z', 'volume_z', 'relative_z', 'spread_z')} FROM escore")
def trailing_zscore(spark, d):
    out = E.equity_measures(ebars(spark, d), ebench(spark, d), eliq(spark, d))
    return out.select("symbol", "ts", *[r(c).alias(c) for c in ("ret_z", "volume_z", "relative_z", "spread_z")])


SCORES = {"gap_pct": "gap", "return_zscore": "ret_z", "volume_zscore": "volume_z", "relative_strength_zscore": "relative_z", "liquidity_spread_zscore": "spread_z"}
ET_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-05:00'"  # the events of January are all in winter time
cte("eact", f"""SELECT *, {ET_SQL} AS at_text, list_filter([CASE WHEN abs(ret_z) >= 3 THEN 'return_zscore' END, CASE WHEN volume_z >= 3 THEN 'volume_spike' END,
  CASE WHEN abs(relative_z) >= 3 THEN 'sector_relative_move' END, CASE WHEN abs(gap) >= {GAP} THEN 'gap' END, CASE WHEN spread_z >= 3 THEN 'liquidity_spread' END],
  lambda x: x IS NOT NULL) AS act, upper(symbol) AS sym FROM escore""")


def equity_events(spark, d):
    return E.detect_equity_events(ebars(spark, d), ebench(spark, d), eliq(spark, d))


@query("equity_abnormal_events", f"""
SELECT 'eq_abn_' || sym || '_' || left(replace(regexp_replace(at_text, '[-:+]', '', 'g'), 'T', '_'), 24) AS event_id, sym AS symbol, at_text AS event_time, at_text AS effective_time,
  'equity_abnormal_activity_event' AS event_type, 'equity_market_data' AS source_type, sym || ' abnormal equity activity' AS title,
  sym || ' triggered ' || array_to_string(act, ', ') || ' over 30Min bars.' AS summary, array_to_string(act, ';') AS abnormal_activity_type,
  '{{"event_time":"' || at_text || '","lookback_intervals":20,"timeframe":"30Min"}}' AS evidence_window,
  {', '.join(f'round({c}, 6) + 0.0 AS {n}' for n, c in SCORES.items())},
  'equity_bar:' || sym || ':' || at_text || CASE WHEN has_liquidity THEN ';equity_liquidity_bar:' || sym || ':' || at_text ELSE '' END
  || CASE WHEN benchmark_ret IS NOT NULL THEN ';benchmark_return:' || at_text ELSE '' END AS source_references,
  '{{"benchmark_present":' || CASE WHEN benchmark_ret IS NOT NULL THEN 'true' ELSE 'false' END || ',"detector":"equity_abnormal_activity_v0"}}' AS taxonomy_context
FROM eact WHERE len(act) > 0""")
def equity_abnormal_events(spark, d):
    out = equity_events(spark, d)
    num = lambda c: (F.nullif(F.col(c), F.lit("")).cast("double") + F.lit(0.0)).alias(c)
    return out.select("event_id", "symbol", "event_time", "effective_time", "event_type", "source_type", "title", "summary", "abnormal_activity_type",
                      "evidence_window", *map(num, SCORES), "source_references", "taxonomy_context")


@query("event_id_equity", """SELECT 'eq_abn_' || upper(symbol) || '_' || left(strftime(bucket, '%Y%m%d_%H%M%S') || '0500', 24) AS event_id, symbol, bucket FROM tb""")
def event_id_equity(spark, d):
    b = P.bars30(spark, d)
    return b.select(Y.event_id_equity(F.upper("symbol"), T.iso_et(F.col("bucket"))).alias("event_id"), "symbol", "bucket")


@query("event_id_fallback", """SELECT event_id, 'evt_' || md5(lower(trim(event_type)) || '|' || CAST(ts AS VARCHAR) || '|' || upper(CAST(user_id AS VARCHAR)) || '|' || trim(props)) AS fallback_id FROM events""")
def event_id_fallback(spark, d):
    ev = P.table(spark, d, "events")
    return ev.select("event_id", Y.event_id_fallback(F.col("event_type"), F.col("ts").cast("string"), F.col("user_id").cast("string"), F.col("props")).alias("fallback_id"))


@query("event_headline", """
SELECT event_id, 'C' || user_id || ' draws ' || array_to_string(list_filter([CASE WHEN k % 2 = 0 THEN 'ask-side activity' END, CASE WHEN k % 3 = 0 THEN 'opening activity' END,
  CASE WHEN k % 5 = 0 THEN 'elevated IV' END, 'other'], lambda x: x IS NOT NULL), ' with ') AS headline,
  upper(event_type) || ' triggered ' || array_to_string(list_filter([CASE WHEN k % 2 = 0 THEN 'trade_at_ask' END, CASE WHEN k % 3 = 0 THEN 'opening_activity' END,
  CASE WHEN k % 5 = 0 THEN 'iv_high_cross_section' END, 'other'], lambda x: x IS NOT NULL), ', ') || ' over input bars.' AS summary
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def event_headline(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    on = F.array_compact(F.array(F.when(k % 2 == 0, "trade_at_ask"), F.when(k % 3 == 0, "opening_activity"), F.when(k % 5 == 0, "iv_high_cross_section"), F.lit("other")))
    return P.table(spark, d, "events").select("event_id", Y.event_headline(F.concat(F.lit("C"), "user_id"), on).alias("headline"),
                                              Y.activity_summary(F.upper("event_type"), on, F.lit("")).alias("summary"))


# ------------------------------------------------------------------ options

cte("otq", """SELECT upper(symbol) AS underlying, '2024-02-16' AS expiration, CASE WHEN size % 2 = 0 THEN 'CALL' ELSE 'PUT' END AS option_right_type,
  CAST(100 + size % 5 AS DOUBLE) + 0.5 * (size % 2) AS strike, ts, ts - INTERVAL '7 milliseconds' AS quote_ts, seq, price, size,
  CASE WHEN seq % 13 = 0 THEN NULL ELSE price - (seq % 3) * 0.1 END AS bid, price - (seq % 3) * 0.1 + (seq % 4) * 0.1 AS ask FROM trades""")
KEYS = ("underlying", "expiration", "option_right_type", "strike")
ASK = {"max_price_vs_ask": 0.01, "min_ask_touch_ratio": 0.95}
OPEN = {"min_window_volume": 150, "min_volume_percentile_20d_same_time": None}
IVS = {"min_iv_percentile_by_expiration": 0.8, "min_iv_zscore_by_expiration": 0.5}


def otq(spark, d):
    k, s, p = F.col("size"), F.col("seq"), F.col("price")
    low = p - (s % 3) * 0.1
    return P.trades(spark, d).select(
        F.upper("symbol").alias("underlying"), F.lit("2024-02-16").alias("expiration"), F.when(k % 2 == 0, "CALL").otherwise("PUT").alias("option_right_type"),
        ((100 + k % 5).cast("double") + 0.5 * (k % 2)).alias("strike"), "ts", F.timestamp_add("MILLISECOND", F.lit(-7), F.col("ts")).alias("quote_ts"), "seq", "price", "size",
        F.when(s % 13 != 0, low).alias("bid"), (low + (s % 4) * 0.1).alias("ask"))


TOUCH = "CASE WHEN price IS NULL OR bid IS NULL OR ask IS NULL THEN NULL WHEN ask = bid THEN CASE WHEN price >= ask THEN 1.0 ELSE 0.0 END ELSE (price - bid) / (ask - bid) END"
cte("ohit", f"SELECT *, price - ask AS pva, {TOUCH} AS touch, coalesce(price - ask <= 0.01 AND {TOUCH} >= 0.95, false) AS hit, time_bucket(INTERVAL '1 hour', ts) AS bucket FROM otq")
cte("owin", """SELECT *, coalesce(lag(window_volume) OVER w, 0) AS prior FROM (SELECT underlying, expiration, option_right_type, strike, bucket, count(*) AS window_trade_count,
  CAST(sum(size) AS BIGINT) AS window_volume, sum(price * size) AS window_notional, bool_or(hit) AS has_ask_trade,
  coalesce(arg_min(seq, row(ts, seq)) FILTER (hit), arg_max(seq, row(size, -epoch_us(ts), -seq))) AS pick_seq FROM ohit GROUP BY ALL)
  WINDOW w AS (PARTITION BY underlying, expiration, option_right_type, strike ORDER BY bucket)""")


@query("price_vs_ask", f"SELECT seq, {rs('pva')} AS price_vs_ask, {rs('touch')} AS ask_touch_ratio FROM ohit")
def price_vs_ask(spark, d):
    p, b, a = F.col("price"), F.col("bid"), F.col("ask")
    return otq(spark, d).select("seq", r(Q.price_vs_ask(p, a)).alias("price_vs_ask"), r(Q.ask_touch_ratio(p, b, a)).alias("ask_touch_ratio"))


@query("trade_at_ask_trigger", "SELECT seq, hit FROM ohit")
def trade_at_ask_trigger(spark, d):
    return otq(spark, d).select("seq", E.at_ask(F.col("price"), F.col("bid"), F.col("ask"), ASK).alias("hit"))


def owin(spark, d):
    return E.window_stats(otq(spark, d), "1Hour", KEYS, ask_standard=ASK)


@query("window_activity_stats", f"""
SELECT underlying, expiration, option_right_type, strike, bucket, window_trade_count, window_volume, {rs('window_notional')} AS window_notional,
  prior = 0 AS first_seen_in_window, {rs('window_volume / nullif(prior, 0)')} AS volume_vs_prior_window_ratio FROM owin""")
def window_activity_stats(spark, d):
    return owin(spark, d).select(*KEYS, "bucket", "window_trade_count", "window_volume", r("window_notional").alias("window_notional"),
                                 "first_seen_in_window", r("volume_vs_prior_window_ratio").alias("volume_vs_prior_window_ratio"))


@query("prior_window_volume", "SELECT underlying, option_right_type, strike, bucket, window_volume, prior AS contract_prior_window_volume FROM owin")
def prior_window_volume(spark, d):
    return owin(spark, d).select("underlying", "option_right_type", "strike", "bucket", "window_volume", "contract_prior_window_volume")


@query("trigger_trade_pick", f"""
SELECT o.underlying, o.option_right_type, o.strike, o.bucket, h.ts AS trade_ts, h.size AS trade_size, {rs('h.price')} AS trade_price, has_ask_trade
FROM owin o JOIN ohit h ON h.seq = o.pick_seq""")
def trigger_trade_pick(spark, d):
    return owin(spark, d).select("underlying", "option_right_type", "strike", "bucket", F.col("trade.ts").alias("trade_ts"), F.col("trade.size").alias("trade_size"),
                                 r("trade.price").alias("trade_price"), "has_ask_trade")


@query("opening_activity_trigger", "SELECT underlying, option_right_type, strike, bucket, window_volume >= 150 AS opening FROM owin")
def opening_activity_trigger(spark, d):
    hit = E.opening_activity(F.col("window_volume"), F.lit(None).cast("double"), OPEN)
    return owin(spark, d).select("underlying", "option_right_type", "strike", "bucket", hit.alias("opening"))


# implied volatility per contract: its mean traded price, ranked inside one expiration
cte("oiv", """SELECT *, percent_rank() OVER w AS iv_percentile_by_expiration, (implied_vol - avg(implied_vol) OVER p) / nullif(stddev_pop(implied_vol) OVER p, 0) AS iv_zscore_by_expiration,
  rank() OVER w AS iv_rank_in_expiration, count(*) OVER p AS expiration_chain_contract_count FROM
  (SELECT underlying, expiration, option_right_type, strike, round(avg(price), 6) AS implied_vol FROM otq GROUP BY ALL)
  WINDOW w AS (PARTITION BY underlying, expiration ORDER BY implied_vol), p AS (PARTITION BY underlying, expiration)""")


def oiv(spark, d):
    from ..operators.chains import iv_cross_section

    per = otq(spark, d).groupBy(*KEYS).agg(F.round(F.avg("price"), 6).alias("implied_vol"))
    return iv_cross_section(per, ["underlying", "expiration"])


@query("iv_cross_section", f"""
SELECT underlying, option_right_type, strike, {rlist('implied_vol', 'iv_percentile_by_expiration', 'iv_zscore_by_expiration', places=5)}, iv_rank_in_expiration, expiration_chain_contract_count FROM oiv""")
def iv_cross_section(spark, d):
    out = rounded(oiv(spark, d), "implied_vol", "iv_percentile_by_expiration", "iv_zscore_by_expiration", places=5)
    return out.drop("expiration")


@query("iv_high_trigger", "SELECT underlying, option_right_type, strike, coalesce(iv_percentile_by_expiration >= 0.8 AND iv_zscore_by_expiration >= 0.5, false) AS iv_high FROM oiv")
def iv_high_trigger(spark, d):
    hit = E.iv_high(F.col("iv_percentile_by_expiration"), F.col("iv_zscore_by_expiration"), IVS)
    return oiv(spark, d).select("underlying", "option_right_type", "strike", hit.alias("iv_high"))


cte("oevt", """SELECT o.*, h.ts AS trade_ts, h.price, h.size, h.bid, h.ask, h.quote_ts, h.pva, h.touch, v.implied_vol,
  list_filter([CASE WHEN has_ask_trade THEN 'trade_at_ask' END, CASE WHEN window_volume >= 150 THEN 'opening_activity' END,
    CASE WHEN iv_percentile_by_expiration >= 0.8 AND iv_zscore_by_expiration >= 0.5 THEN 'iv_high_cross_section' END], lambda x: x IS NOT NULL) AS trig,
  o.underlying || ' ' || o.expiration || ' ' || CASE WHEN o.strike = floor(o.strike) THEN CAST(CAST(o.strike AS BIGINT) AS VARCHAR) ELSE CAST(o.strike AS VARCHAR) END
    || left(o.option_right_type, 1) AS contract
  FROM owin o JOIN ohit h ON h.seq = o.pick_seq LEFT JOIN oiv v ON v.underlying = o.underlying AND v.expiration = o.expiration AND v.option_right_type = o.option_right_type AND v.strike = o.strike""")
cte("ofirst", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY underlying, expiration, option_right_type, strike ORDER BY bucket) AS n FROM oevt WHERE len(trig) > 0)""")


def oevents(spark, d, max_events=None):
    standards = {"trade_at_ask": ASK, "opening_activity": OPEN, "iv_high_cross_section": IVS}
    return E.detect_option_events(otq(spark, d), standards, "1Hour", iv=oiv(spark, d), max_events=max_events,
                                  standard_context={"standard_id": "std", "generated_at": "2024-02-01T00:00:00-05:00"})


@query("option_activity_events", """
SELECT contract || ' draws ' || array_to_string(list_transform(trig, lambda x: CASE x WHEN 'trade_at_ask' THEN 'ask-side activity' WHEN 'opening_activity' THEN 'opening activity' ELSE 'elevated IV' END), ' with ')
  AS timeline_headline, underlying || ';' || contract AS symbols, array_to_string(trig, ';') AS summary, '2024-02-01T00:00:00-05:00' AS updated_at, bucket,
  'opt_evt_' || md5(underlying || '|' || expiration || '|' || option_right_type || '|' || CAST(strike AS VARCHAR) || '|' || CAST(bucket AS VARCHAR)) AS event_id,
  strftime(trade_ts, '%Y-%m-%dT%H:%M:%S') AS created_second FROM ofirst""")
def option_activity_events(spark, d):
    return oevents(spark, d).select("event_id", "timeline_headline", "symbols", "summary", "updated_at", "bucket", F.left("created_at", F.lit(19)).alias("created_second"))


@query("event_detail_rows", f"""
SELECT underlying, expiration, option_right_type, strike, contract AS contract_symbol, strftime(bucket, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS window_start, size AS trade_size,
  {rs('price')} AS trade_price, {rs('ask')} AS quote_ask, {rs('CASE WHEN has_ask_trade THEN touch END')} AS ask_touch_ratio,
  CASE WHEN window_volume >= 150 THEN window_volume END AS window_volume, {rs('implied_vol', 5)} AS implied_vol, 'not_persisted_by_default' AS raw_persistence FROM ofirst""")
def event_detail_rows(spark, d):
    x = E.event_detail_rows(oevents(spark, d))
    at = lambda c, p: F.get_json_object(c, p)
    return x.select("underlying", "expiration", "option_right_type", "strike", "contract_symbol", at("evidence_window", "$.window_start").alias("window_start"),
                    at("triggering_trade", "$.trade_size").cast("bigint").alias("trade_size"), r(at("triggering_trade", "$.trade_price")).alias("trade_price"),
                    r(at("quote_context", "$.ask")).alias("quote_ask"), r(at("triggered_indicators", "$.trade_at_ask.statistics.ask_touch_ratio")).alias("ask_touch_ratio"),
                    at("triggered_indicators", "$.opening_activity.statistics.window_volume").cast("bigint").alias("window_volume"),
                    r(at("iv_context", "$.implied_vol"), 5).alias("implied_vol"), at("source_references", "$.raw_persistence").alias("raw_persistence"))


@query("first_n_events", "SELECT contract AS contract_symbol, bucket, array_to_string(trig, ';') AS summary FROM ofirst WHERE n <= 3")
def first_n_events(spark, d):
    return oevents(spark, d, 3).select("contract_symbol", "bucket", "summary")


# share of same-time-of-day windows of the 20 days before with at most this volume
@query("volume_percentile_20d_same_time", f"""
SELECT a.underlying, a.option_right_type, a.strike, a.bucket, {rs('avg(CAST(b.window_volume <= a.window_volume AS INT))')} AS volume_percentile_20d_same_time
FROM owin a LEFT JOIN owin b ON a.underlying = b.underlying AND a.expiration = b.expiration AND a.option_right_type = b.option_right_type AND a.strike = b.strike
  AND CAST(a.bucket AS TIME) = CAST(b.bucket AS TIME) AND b.bucket < a.bucket AND b.bucket >= a.bucket - INTERVAL '20 days' GROUP BY ALL""")
def volume_percentile_20d_same_time(spark, d):
    from ..operators.chains import same_time_percentile

    out = same_time_percentile(owin(spark, d), KEYS, 20)
    return out.select("underlying", "option_right_type", "strike", "bucket", r("volume_percentile_20d_same_time").alias("volume_percentile_20d_same_time"))


# ------------------------------------------------------------------ event overview

@query("event_overview_normalize", """
SELECT 'evt_' || event_id AS event_id, ts AS event_time, CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL '1 minute' ELSE ts END AS available_time,
  CASE WHEN event_id % 2 = 0 THEN 'prior_signal' ELSE 'lagging_evidence' END AS information_role_type,
  CASE event_type WHEN 'click' THEN 'macro_data' WHEN 'view' THEN 'symbol_news' WHEN 'purchase' THEN 'sec_filing' WHEN 'signup' THEN 'sector_news' END AS event_category_type,
  CASE WHEN event_id % 2 = 0 THEN 'symbol' ELSE 'macro' END AS scope_type, CASE WHEN event_id % 4 <> 0 THEN 'U' || user_id END AS symbol,
  'Title ' || event_id AS title, 'source_reference' AS reference_type, props AS reference, CASE WHEN event_type = 'error' THEN 'event_category_type' END AS bad_field FROM events""")
def event_overview_normalize(spark, d):
    i, t = F.col("event_id"), F.col("event_type")
    raw = P.table(spark, d, "events").select(
        F.concat(F.lit("evt_"), i).alias("event_id"), F.col("ts").cast("string").alias("event_time"),
        F.when(i % 3 == 0, (F.col("ts") + F.make_dt_interval(mins=F.lit(1))).cast("string")).alias("available_time"),
        F.when(i % 2 == 0, "Prior_Signal ").otherwise("lagging_evidence").alias("information_role_type"),
        F.when(t == "click", "macro_data").when(t == "view", "symbol_news").when(t == "purchase", "SEC_filing").when(t == "signup", "sector_news").otherwise("junk").alias("event_category_type"),
        F.when(i % 2 == 0, "symbol").otherwise("macro").alias("scope_type"), F.when(i % 4 != 0, F.concat(F.lit(" u"), "user_id")).otherwise("").alias("symbol"),
        F.concat(F.lit("Title "), i).alias("headline"), F.col("props").alias("event_link_url"))
    return K.normalize_events(raw, strict=False).drop("sector_type", "summary", "source_name")


@query("required_field_check", """
SELECT event_id, CASE WHEN k % 10 = 0 THEN 'symbol' ELSE 'reference' END AS missing_field FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
WHERE k % 10 = 0 OR k % 7 = 0""")
def required_field_check(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = P.table(spark, d, "events").select("event_id", F.when(k % 10 != 0, F.col("event_type")).otherwise(" ").alias("symbol"), F.when(k % 7 != 0, F.col("props")).alias("reference"))
    return K.missing_required(rows, ["symbol", "reference"]).select("event_id", "missing_field")


@query("ordered_outputs", "SELECT event_id, ts, event_type, user_id, row_number() OVER (ORDER BY event_type, ts, event_id) AS position FROM events")
def ordered_outputs(spark, d):
    from ..operators.windows import index_rows

    rows = P.table(spark, d, "events").select("event_id", "ts", "event_type", "user_id")
    per_type = index_rows(rows, ["event_type"], "ts", ["ts", "event_id"], "day", "rn")
    sizes = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("event_type", (F.sum("n").over(Window.orderBy("event_type")) - F.col("n")).alias("base"))  # a row for each type
    return per_type.join(before, "event_type").withColumn("position", F.col("base") + F.col("rn")).drop("base", "rn").orderBy("position")


@query("fmt6", "SELECT event_id, rtrim(rtrim(printf('%.6f', value * 1.5), '0'), '.') AS text FROM events")
def fmt6_query(spark, d):
    return P.table(spark, d, "events").select("event_id", fmt6(F.col("value") * 1.5).alias("text"))
