"""Queries: daily indicators, pair features and feature tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.numbers import safe_div, safe_log_ratio
from ..operators import indicators as I
from ..operators.epochs import common_epochs, expand, snapshot_grid, with_times
from ..plans import features as X
from ..shared import staged
from . import proxies as P
from .joins import daily, ends
from .registry import cte, query, r, rlist, rounded, rs

A = repr(math.sqrt(252))

cte("ind1", f"""SELECT *, row_number() OVER w AS idx, lag(c) OVER w AS pc, ln(c / lag(c) OVER w) AS r1, ln(c / lag(c, 5) OVER w) AS r5, ln(c / lag(c, 20) OVER w) AS r20,
  CASE WHEN count(c) OVER w20 = 20 THEN avg(c) OVER w20 END AS ma20, CASE WHEN count(c) OVER w50 = 50 THEN avg(c) OVER w50 END AS ma50,
  CASE WHEN count(c) OVER w200 = 200 THEN avg(c) OVER w200 END AS ma200,
  CASE WHEN count(*) OVER w20 = 20 THEN sqrt(sum(ln(h / l) * ln(h / l)) OVER w20 / (80 * ln(CAST(2 AS DOUBLE)))) * {A} END AS parkinson,
  CASE WHEN count(*) OVER w20 = 20 THEN avg(0.5 * ln(h / l) * ln(h / l) - (2 * ln(CAST(2 AS DOUBLE)) - 1) * ln(c / o) * ln(c / o)) OVER w20 END AS gkm
  FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY ts), w20 AS (PARTITION BY symbol ORDER BY ts ROWS 19 PRECEDING),
  w50 AS (PARTITION BY symbol ORDER BY ts ROWS 49 PRECEDING), w200 AS (PARTITION BY symbol ORDER BY ts ROWS 199 PRECEDING)""")
cte("ind2", f"""SELECT *, CASE WHEN count(r1) OVER w5 = 5 THEN stddev_pop(r1) OVER w5 * {A} END AS vol5, CASE WHEN count(r1) OVER w20 = 20 THEN stddev_pop(r1) OVER w20 * {A} END AS vol20,
  CASE WHEN count(r1) OVER w60 = 60 THEN stddev_pop(r1) OVER w60 * {A} END AS vol60, greatest(h - l, abs(h - pc), abs(l - pc)) AS tr0,
  lag(ma20, 5) OVER w AS ma20p, lag(ma50, 10) OVER w AS ma50p, lag(ma200, 20) OVER w AS ma200p
  FROM ind1 WINDOW w AS (PARTITION BY symbol ORDER BY ts), w5 AS (PARTITION BY symbol ORDER BY ts ROWS 4 PRECEDING),
  w20 AS (PARTITION BY symbol ORDER BY ts ROWS 19 PRECEDING), w60 AS (PARTITION BY symbol ORDER BY ts ROWS 59 PRECEDING)""")
cte("ind3", """SELECT *, CASE WHEN count(pc) OVER w14 = 14 THEN avg(CASE WHEN pc IS NOT NULL THEN tr0 END) OVER w14 / c END AS atr,
  CASE WHEN count(vol20) OVER w252 = 252 THEN (vol20 - avg(vol20) OVER w252) / nullif(stddev_pop(vol20) OVER w252, 0) END AS vol_z,
  CASE WHEN count(vol20) OVER w252 = 252 THEN list(vol20) OVER w252 END AS vol_hist
  FROM ind2 WINDOW w14 AS (PARTITION BY symbol ORDER BY ts ROWS 13 PRECEDING), w252 AS (PARTITION BY symbol ORDER BY ts ROWS 251 PRECEDING)""")
cte("ewma", f"""SELECT a.symbol, a.idx, sqrt(sum(CASE WHEN b.idx = 2 THEN 1.0 ELSE 1 - CAST(0.94 AS DOUBLE) END * b.r1 * b.r1 * pow(CAST(0.94 AS DOUBLE), a.idx - b.idx))) * {A} AS ewma_vol
  FROM ind1 a JOIN ind1 b ON a.symbol = b.symbol AND b.idx <= a.idx AND b.r1 IS NOT NULL WHERE a.r1 IS NOT NULL GROUP BY ALL""")
TREND = """c / ma20 - 1 AS distance_to_ma20, c / ma50 - 1 AS distance_to_ma50, c / ma200 - 1 AS distance_to_ma200,
  ma20 / ma20p - 1 AS ma20_slope_5d, ma50 / ma50p - 1 AS ma50_slope_10d, ma200 / ma200p - 1 AS ma200_slope_20d,
  sign(c - ma20) + sign(ma20 - ma50) + sign(ma50 - ma200) AS ma_alignment_score, ma20 / ma50 - 1 AS ma20_ma50_spread, ma50 / ma200 - 1 AS ma50_ma200_spread"""
cte("ind", f"""SELECT i.* EXCLUDE (vol_hist), len(list_filter(vol_hist, lambda x: x <= vol20)) / CAST(252 AS DOUBLE) AS vol_pct, e.ewma_vol,
  CASE WHEN gkm >= 0 THEN sqrt(gkm) * {A} END AS gk, vol5 / vol20 AS vol_5_20, vol20 / vol60 AS vol_20_60, {TREND}
  FROM ind3 i LEFT JOIN ewma e ON i.symbol = e.symbol AND i.idx = e.idx""")


def indicators(spark, d, bars=None):
    return I.daily_indicators(bars if bars is not None else P.daily_bars(spark, d))


def single(key: str, columns: dict[str, str], places: int = 6):
    """A query that shows some indicator columns at every daily bar; maps Spark name to SQL expression."""
    body = ", ".join(f"{rs(expr, places)} AS {name}" for name, expr in columns.items())

    @query(key, f"SELECT symbol, ts, {body} FROM ind")
    def run(spark, d):
        return indicators(spark, d).select("symbol", "ts", *[r(n, places).alias(n) for n in columns])

    return run


single("log_return_n", {"return_1d": "r1", "return_5d": "r5", "return_20d": "r20"})
single("realized_vol", {"realized_vol_5d": "vol5", "realized_vol_20d": "vol20", "realized_vol_60d": "vol60"})
single("vol_term_ratios", {"realized_vol_5d_20d_ratio": "vol_5_20", "realized_vol_20d_60d_ratio": "vol_20_60"})
single("ewma_vol", {"ewma_vol": "ewma_vol"})
single("atr_pct", {"atr_pct_14d": "atr"})
single("vol_percentile_252", {"realized_vol_20d_percentile_252d": "vol_pct"})
single("vol_zscore_252", {"realized_vol_20d_zscore_252d": "vol_z"})
single("parkinson_vol", {"parkinson_vol_20d": "parkinson"})
single("garman_klass_vol", {"garman_klass_vol_20d": "gk"})
single("moving_average", {"ma20": "ma20", "ma50": "ma50", "ma200": "ma200"}, places=4)
single("distance_to_ma", {f"distance_to_ma{w}": f"distance_to_ma{w}" for w in (20, 50, 200)})
single("ma_slope", {n: n for n in ("ma20_slope_5d", "ma50_slope_10d", "ma200_slope_20d")})
single("ma_alignment_score", {"ma_alignment_score": "ma_alignment_score"})
single("ma_spreads", {"ma20_ma50_spread": "ma20_ma50_spread", "ma50_ma200_spread": "ma50_ma200_spread"})


@query("daily_log_returns", f"SELECT symbol, idx - 1 AS idx, {rs('r1')} AS value FROM ind WHERE r1 IS NOT NULL")
def daily_log_returns(spark, d):
    return I.return_series(indicators(spark, d)).select("symbol", "idx", r("value").alias("value"))


# what each symbol's latest close was, now and 30 minutes before
cte("marks30", """SELECT s.snapshot_time, u.symbol, n.c AS now_c, b.c AS before_c, n.idx AS now_i, b.idx AS before_i FROM snaps s CROSS JOIN usyms u
  ASOF LEFT JOIN ind1 n ON n.symbol = u.symbol AND s.snapshot_time >= n.avail
  ASOF LEFT JOIN ind1 b ON b.symbol = u.symbol AND s.snapshot_time - INTERVAL '30 minutes' >= b.avail""")


@query("return_30m", f"SELECT snapshot_time, symbol, {rs('ln(now_c / before_c)')} AS return_30m FROM marks30")
def return_30m(spark, d):
    grid = snapshot_grid(P.snapshots(spark, d))
    spans = X.mark_epochs(P.daily_bars(spark, d), P.universe(spark, d).select("symbol"), grid)
    moved = spans.select("symbol", *X.SPAN, r(safe_log_ratio(F.col("close_now"), F.col("close_before"))).alias("return_30m"))
    return expand(moved, grid)


cte("trend", f"""SELECT numerator, denominator, n_num, n_den, ln(cur / prev) AS ratio_return_1d, {TREND} FROM (SELECT numerator, denominator, n_num, n_den, count(*) AS n,
  max(ratio) FILTER (k = 0) AS c, max(ratio) FILTER (k = 0) AS cur, max(ratio) FILTER (k = 1) AS prev,
  CASE WHEN count(*) >= 20 THEN avg(ratio) FILTER (k < 20) END AS ma20, CASE WHEN count(*) >= 50 THEN avg(ratio) FILTER (k < 50) END AS ma50,
  CASE WHEN count(*) >= 200 THEN avg(ratio) FILTER (k < 200) END AS ma200, CASE WHEN count(*) >= 25 THEN avg(ratio) FILTER (k >= 5 AND k < 25) END AS ma20p,
  CASE WHEN count(*) >= 60 THEN avg(ratio) FILTER (k >= 10 AND k < 60) END AS ma50p, CASE WHEN count(*) >= 220 THEN avg(ratio) FILTER (k >= 20 AND k < 220) END AS ma200p
  FROM rt GROUP BY ALL)""")


@query("ratio_trend", f"SELECT numerator, denominator, n_num, n_den, {rlist('ratio_return_1d', *I.TREND_FEATURES)} FROM trend")
def ratio_trend(spark, d):
    _, ind, e = ends(spark, d, "idx", "bad", "bar_close")
    return rounded(I.pair_trend(e, I.close_series(ind)), "ratio_return_1d", *I.TREND_FEATURES)


def corr_cte(name: str, source: str) -> None:
    cte(name, f"""SELECT numerator, denominator, r_num, r_den, max(c) FILTER (w = 20) AS return_corr_20d, max(c) FILTER (w = 60) AS return_corr_60d,
  max(c) FILTER (w = 20) - max(c) FILTER (w = 60) AS return_corr_20d_60d_change FROM (
  SELECT e.numerator, e.denominator, r_num, r_den, w, CASE WHEN count(*) >= 2 AND var_pop(a.r1) > 0 AND var_pop(b.r1) > 0 THEN corr(a.r1, b.r1) END AS c FROM
  (SELECT *, unnest(range(1, least(r_num, r_den, w) + 1)) AS k FROM (SELECT DISTINCT numerator, denominator, r_num, r_den, unnest([20, 60]) AS w FROM {source} WHERE r_num > 0 AND r_den > 0)) e
  JOIN ind a ON a.symbol = e.numerator AND a.idx = 1 + greatest(r_num - w, 0) + k JOIN ind b ON b.symbol = e.denominator AND b.idx = 1 + greatest(r_den - w, 0) + k
  GROUP BY ALL) GROUP BY ALL""")


corr_cte("pcorr", "ends")


@query("pair_return_corr", f"SELECT numerator, denominator, r_num AS n_num, r_den AS n_den, {rlist(*I.CORR_FEATURES)} FROM pcorr")
def pair_return_corr(spark, d):
    _, ind, e = ends(spark, d, "ret_idx", "return_1d")
    return rounded(I.return_corr(e, I.return_series(ind)), *I.CORR_FEATURES)


@query("pair_vol_ratio", """SELECT n.snapshot_time, combination_id, """ + rs("a.vol20 / nullif(b.vol20, 0)") + """ AS realized_vol_20d_ratio
FROM pairs p JOIN seen n ON n.symbol = p.numerator JOIN seen m ON m.symbol = p.denominator AND m.snapshot_time = n.snapshot_time
LEFT JOIN ind a ON a.symbol = p.numerator AND a.idx = n.idx LEFT JOIN ind b ON b.symbol = p.denominator AND b.idx = m.idx""")
def pair_vol_ratio(spark, d):
    grid, _, e = ends(spark, d, "realized_vol_20d")
    ratio = safe_div(F.col("num_realized_vol_20d"), F.col("den_realized_vol_20d"))
    return expand(e.select(*X.SPAN, "combination_id", r(ratio).alias("realized_vol_20d_ratio")), grid)


# pair features by span: those that follow daily bars, and the relative strength return of either grain
cte("pf", """SELECT e.*, num_vol / nullif(den_vol, 0) AS realized_vol_20d_ratio, t.* EXCLUDE (numerator, denominator, n_num, n_den),
  c.return_corr_20d, c.return_corr_60d, c.return_corr_20d_60d_change
  FROM ends e LEFT JOIN trend t USING (numerator, denominator, n_num, n_den) LEFT JOIN pcorr c USING (numerator, denominator, r_num, r_den)""")
cte("strength", """SELECT p.combination_id, p.combination_type, p.numerator, p.denominator, p.feature_bar_grain, min(a.snapshot_time) AS first_snapshot, max(a.snapshot_time) AS last_snapshot, count(*) AS n_snapshots,
  any_value(ln((a.now_c / b.now_c) / (a.before_c / b.before_c))) AS relative_strength_return
  FROM pairs p JOIN marks30 a ON a.symbol = p.numerator JOIN marks30 b ON b.symbol = p.denominator AND b.snapshot_time = a.snapshot_time
  WHERE p.feature_bar_grain = '30m' GROUP BY p.combination_id, p.combination_type, p.numerator, p.denominator, p.feature_bar_grain, a.now_i, a.before_i, b.now_i, b.before_i
  UNION ALL SELECT combination_id, combination_type, numerator, denominator, feature_bar_grain, first_snapshot, last_snapshot, n_snapshots, ratio_return_1d FROM pf WHERE feature_bar_grain <> '30m'""")


@query("relative_strength_return", f"""SELECT snapshot_time, combination_id, feature_bar_grain, {rs('relative_strength_return')} AS relative_strength_return
FROM strength JOIN snaps ON snapshot_time BETWEEN first_snapshot AND last_snapshot""")
def relative_strength_return(spark, d):
    bars = staged(P.daily_bars(spark, d).select(*X.BAR_COLUMNS), "bars")
    grid, ind, e = ends(spark, d, "idx", "bad", "bar_close", bars=bars)
    keyed = e.withColumns({"n_num": F.col("num_idx"), "n_den": F.col("den_idx")})
    stepped = keyed.join(I.pair_trend(e, I.close_series(ind)).select(*I.END, "ratio_return_1d"), list(I.END), "left")
    pairs = P.pairs(spark, d)
    out = X.relative_strength(pairs, staged(X.mark_epochs(bars, X.legs_of(pairs), grid), "marks"), stepped, grid)
    out = out.select(*X.SPAN, "combination_id", "feature_bar_grain", r("relative_strength_return").alias("relative_strength_return"))
    return expand(out, grid)


BREADTH = ("sector_observation_positive_return_1d_pct", "sector_observation_positive_return_5d_pct", "sector_observation_above_ma20_pct",
           "sector_observation_above_ma50_pct", "sector_observation_above_ma200_pct", "sector_observation_distance_to_ma20_avg",
           "sector_observation_distance_to_ma20_dispersion", "sector_observation_return_20d_dispersion")
cte("breadth", """SELECT snapshot_time, avg(CAST(r1 > 0 AS INT)) AS sector_observation_positive_return_1d_pct, avg(CAST(r5 > 0 AS INT)) AS sector_observation_positive_return_5d_pct,
  avg(CAST(c > ma20 AS INT)) AS sector_observation_above_ma20_pct, avg(CAST(c > ma50 AS INT)) AS sector_observation_above_ma50_pct,
  avg(CAST(c > ma200 AS INT)) AS sector_observation_above_ma200_pct, avg(c / ma20 - 1) AS sector_observation_distance_to_ma20_avg,
  CASE WHEN count(ma20) >= 2 THEN stddev_pop(c / ma20 - 1) END AS sector_observation_distance_to_ma20_dispersion,
  CASE WHEN count(r20) >= 2 THEN stddev_pop(r20) END AS sector_observation_return_20d_dispersion
  , sum(idx) AS seen_bars FROM seen JOIN ind USING (symbol, idx) WHERE symbol IN (SELECT symbol FROM universe WHERE universe_type = 'sector_observation_etf') GROUP BY snapshot_time""")


@query("sector_breadth", f"SELECT snapshot_time, {rlist(*BREADTH)} FROM snaps LEFT JOIN breadth USING (snapshot_time)")
def sector_breadth(spark, d):
    grid, _, seen = daily(spark, d, "idx", "bar_close", "return_1d", "return_5d", "return_20d", *[f"ma{w}" for w in I.MA_WINDOWS])
    observed = seen.join(X.symbols_of(P.universe(spark, d), X.SECTOR_OBSERVATION), "symbol", "left_semi")
    return rounded(expand(X.breadth(observed, grid), grid), *BREADTH)


cte("msends", """SELECT n.snapshot_time, a.symbol AS numerator, b.symbol AS denominator, n.idx - 1 AS r_num, m.idx - 1 AS r_den
  FROM universe a JOIN universe b ON a.n <= 10 AND b.n <= 10 AND a.symbol < b.symbol JOIN seen n ON n.symbol = a.symbol JOIN seen m ON m.symbol = b.symbol AND m.snapshot_time = n.snapshot_time""")
corr_cte("mscorr", "msends")
CONC = [f"market_state_{n}_{w}d" for w in (20, 60) for n in ("avg_return_corr", "avg_abs_return_corr", "return_corr_dispersion")]
cte("conc", "SELECT s.snapshot_time, " + ", ".join(
    f"avg(return_corr_{w}d) AS market_state_avg_return_corr_{w}d, avg(abs(return_corr_{w}d)) AS market_state_avg_abs_return_corr_{w}d, "
    f"CASE WHEN count(return_corr_{w}d) >= 2 THEN stddev_pop(return_corr_{w}d) END AS market_state_return_corr_dispersion_{w}d" for w in (20, 60)
) + " FROM snaps s LEFT JOIN msends e ON e.snapshot_time = s.snapshot_time LEFT JOIN mscorr c USING (numerator, denominator, r_num, r_den) GROUP BY ALL")


@query("corr_concentration", f"SELECT snapshot_time, {rlist(*CONC)} FROM conc")
def corr_concentration(spark, d):
    grid, ind, seen = daily(spark, d, "ret_idx", "return_1d")
    symbols = X.symbols_of(P.universe(spark, d), X.MARKET_STATE)
    return rounded(expand(X.concentration(symbols, seen.join(symbols, "symbol", "left_semi"), ind, grid), grid), *CONC)


# ------------------------------------------------------------------ feature tables

EXCLUDED = ("BRAND#1",)
SQL_VOL = {"realized_vol_5d": "vol5", "realized_vol_20d": "vol20", "realized_vol_60d": "vol60", "realized_vol_5d_20d_ratio": "vol_5_20",
           "realized_vol_20d_60d_ratio": "vol_20_60", "ewma_vol": "ewma_vol", "atr_pct_14d": "atr", "realized_vol_20d_percentile_252d": "vol_pct",
           "realized_vol_20d_zscore_252d": "vol_z", "parkinson_vol_20d": "parkinson", "garman_klass_vol_20d": "gk"}


def melt_sql(prefix: str, columns: dict[str, str], source: str) -> str:
    items = ", ".join(f"{{'f': '{name}', 'v': CAST({expr} AS DOUBLE)}}" for name, expr in columns.items())
    return f"SELECT first_snapshot, last_snapshot, n_snapshots, {prefix} || x.f AS feature, x.v AS value FROM (SELECT *, unnest([{items}]) AS x FROM {source})"


SPANNED = "min(snapshot_time) AS first_snapshot, max(snapshot_time) AS last_snapshot, count(*) AS n_snapshots"
MOVES = {"return_1d": "r1", "return_5d": "r5", "return_20d": "r20", **{n: n for n in I.TREND_FEATURES}}
PAIRF = {n: n for n in ("realized_vol_20d_ratio", *I.TREND_FEATURES, *I.CORR_FEATURES)}
cte("spans", f"""SELECT s.*, i.* EXCLUDE (symbol, idx) FROM (SELECT symbol, idx, {SPANNED} FROM seen GROUP BY symbol, idx) s LEFT JOIN ind i ON s.symbol = i.symbol AND s.idx = i.idx""")
cte("quick", f"SELECT symbol, {SPANNED}, any_value(ln(now_c / before_c)) AS value FROM marks30 GROUP BY symbol, now_i, before_i")
cte("state_bars", "SELECT snapshot_time, sum(coalesce(idx, 0)) AS bars FROM seen WHERE symbol IN (SELECT symbol FROM universe WHERE n <= 10) GROUP BY snapshot_time")
cte("conc_spans", f"""SELECT {SPANNED}, {', '.join(f'any_value({n}) AS {n}' for n in CONC)} FROM conc JOIN state_bars USING (snapshot_time) GROUP BY bars""")
cte("regime", " UNION ALL ".join([
    melt_sql("lower(symbol) || '_'", SQL_VOL, "spans WHERE symbol IN (SELECT symbol FROM universe WHERE n <= 10)"),
    melt_sql("lower(symbol) || '_'", MOVES, "spans WHERE symbol IN (SELECT symbol FROM universe WHERE n BETWEEN 2 AND 10)"),
    "SELECT first_snapshot, last_snapshot, n_snapshots, lower(symbol) || '_return_30m', value FROM quick WHERE symbol IN (SELECT symbol FROM universe WHERE n BETWEEN 2 AND 10)",
    melt_sql("combination_id || '_'", PAIRF, "pf WHERE combination_type = 'primary'"),
    "SELECT first_snapshot, last_snapshot, n_snapshots, combination_id || '_' || feature_bar_grain, relative_strength_return FROM strength WHERE combination_type = 'primary'",
    melt_sql("''", {n: n for n in CONC}, "conc_spans"),
]))


def regime(spark, d):
    grid = snapshot_grid(P.snapshots(spark, d))
    return grid, X.regime_spans(P.daily_bars(spark, d), P.universe(spark, d), P.pairs(spark, d), grid, EXCLUDED)


@query("regime_features", f"SELECT first_snapshot, last_snapshot, n_snapshots, feature, {rs('value')} AS value FROM regime")
def regime_features(spark, d):
    """Each feature by the runs of snapshots in which no bar that it rests on changes; together they are all snapshots."""
    grid, spans = regime(spark, d)
    return rounded(with_times(spans, grid), "value")


META = "numerator AS candidate_symbol, 'sector_industry_etf' AS candidate_type, denominator AS comparison_symbol, combination_id AS rotation_pair_id, combination_type AS rotation_pair_type, feature_bar_grain"
TIMES = "first_snapshot, last_snapshot, n_snapshots"
_pair_items = ", ".join(f"{{'f': 'relative_strength_{n}', 'v': CAST({n} AS DOUBLE)}}" for n in PAIRF)
_strength_items = "{'f': 'relative_strength_return', 'v': relative_strength_return}, {'f': 'relative_strength_return_' || feature_bar_grain, 'v': relative_strength_return}"
_breadth_items = ", ".join(f"{{'f': '{n}', 'v': CAST({n} AS DOUBLE)}}" for n in BREADTH)
cte("breadth_spans", f"SELECT {SPANNED}, {', '.join(f'any_value({n}) AS {n}' for n in BREADTH)} FROM snaps LEFT JOIN breadth USING (snapshot_time) GROUP BY seen_bars")
cte("rotation", f"""SELECT * EXCLUDE x, x.f AS feature, x.v AS value FROM (SELECT {META}, {TIMES}, unnest([{_pair_items}]) AS x FROM pf WHERE combination_type <> 'primary')
  UNION ALL SELECT * EXCLUDE x, x.f AS feature, x.v AS value FROM (SELECT {META}, {TIMES}, unnest([{_strength_items}]) AS x FROM strength WHERE combination_type <> 'primary')
  UNION ALL SELECT * EXCLUDE x, x.f, x.v FROM (SELECT 'SECTOR_OBSERVATION_UNIVERSE', 'sector_rotation_summary', 'MARKET', 'sector_observation_breadth',
  'sector_rotation_summary', 'mixed', {TIMES}, unnest([{_breadth_items}]) AS x FROM breadth_spans)""")


def rotation(spark, d, only=None):
    grid = snapshot_grid(P.snapshots(spark, d))
    return grid, X.rotation_spans(P.daily_bars(spark, d), P.universe(spark, d), P.pairs(spark, d), grid, only)


@query("rotation_features", f"SELECT * EXCLUDE value, {rs('value')} AS value FROM rotation")
def rotation_features(spark, d):
    grid, spans = rotation(spark, d)
    return rounded(with_times(spans, grid), "value")


def payload_stats(df, keys):
    """What a payload holds, in a form that two engines write alike: key count, nulls, digests of names and of values to 6 places."""
    def stats(m):
        values = F.transform(F.map_values(m), lambda v: F.coalesce(F.format_string("%.6f", r(v)), F.lit("null")))
        return F.struct(F.size(m).cast("bigint").alias("n_keys"), F.size(F.filter(F.map_values(m), lambda v: v.isNull())).cast("bigint").alias("n_null"),
                        F.md5(F.array_join(F.map_keys(m), ",")).alias("keys_md5"), F.md5(F.array_join(values, ",")).alias("values_md5"))

    # read once: a lambda's argument is a value, not an expression to repeat
    parsed = F.array(F.from_json("feature_payload_json", "map<string,double>"))
    return df.select(*keys, F.inline(F.transform(parsed, stats)))


def payload_sql(keys: str, source: str) -> str:
    """Payloads at the starts of spans, carried to the snapshots up to the next start of any span."""
    value, by = f"coalesce(printf('%.6f', {rs('value')}), 'null')", f"{keys}, " if keys else ""
    return f"""SELECT {by}s.snapshot_time, n_keys, n_null, keys_md5, values_md5 FROM
      (SELECT {by}since, count(*) AS n_keys, count(*) - count(value) AS n_null, md5(string_agg(feature, ',' ORDER BY feature)) AS keys_md5,
        md5(string_agg({value}, ',' ORDER BY feature)) AS values_md5 FROM {source} JOIN (SELECT DISTINCT first_snapshot AS since FROM {source}) ON since BETWEEN first_snapshot AND last_snapshot GROUP BY {by}since)
      JOIN (SELECT snapshot_time, since FROM snaps ASOF JOIN (SELECT DISTINCT first_snapshot AS since FROM {source}) ON snapshot_time >= since) s USING (since)"""


@query("feature_payload_regime", payload_sql("", "regime"))
def feature_payload_regime(spark, d):
    grid, spans = regime(spark, d)
    return expand(payload_stats(X.fold_payload(common_epochs(spans, []), X.SPAN), X.SPAN), grid)


@query("feature_payload_rotation", payload_sql(", ".join(X.META), "rotation"))
def feature_payload_rotation(spark, d):
    grid, spans = rotation(spark, d)
    keys = [*X.META, *X.SPAN]
    return expand(payload_stats(X.fold_payload(common_epochs(spans, X.META), keys), keys), grid)


@query("payload_columns", "SELECT DISTINCT feature FROM rotation")
def payload_columns(spark, d):
    return X.payload_columns(rotation(spark, d)[1])


@query("signal_average", f"""
SELECT snapshot_time, rotation_pair_id, {rs('avg(value)')} AS signal_average FROM rotation JOIN snaps ON snapshot_time BETWEEN first_snapshot AND last_snapshot
WHERE feature IN ('relative_strength_return', 'relative_strength_distance_to_ma20', 'relative_strength_ma_alignment_score') GROUP BY ALL""")
def signal_average(spark, d):
    grid, spans = rotation(spark, d, X.SIGNAL_FEATURES)
    averaged = X.signal_average(common_epochs(spans, X.META), ["rotation_pair_id", *X.SPAN])
    return rounded(expand(averaged, grid), "signal_average")


@query("infer_snapshots", """
SELECT DISTINCT bucket AS snapshot_time FROM tb WHERE symbol = 'click' AND CAST(bucket AS TIME) > TIME '09:30:00' AND CAST(bucket AS TIME) <= TIME '16:00:00'""")
def infer_snapshots(spark, d):
    bars = P.bars30(spark, d).select("symbol", F.lit("30Min").alias("timeframe"), F.col("bucket").alias("ts"), "bar_open", "bar_high", "bar_low", "bar_close")
    return X.infer_snapshots(I.prepare_bars(bars), "click")
