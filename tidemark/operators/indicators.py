"""Daily-bar indicators, pair features and cross-section aggregates.

Windows here partition by symbol over daily bars only: a symbol's group is bounded by
the calendar (about 250 bars a year), whatever the size of the tick tables behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.numbers import finite, safe_div, safe_log_ratio, sign3
from ..functions.times import available_time, is_daily
from .joins import tail_align
from .windows import full_window, trailing, wide_mean, wide_moments

# Look-backs and smoothing of the indicator set.
VOL_WINDOWS = (5, 20, 60)
MA_WINDOWS = (20, 50, 200)
MA_SLOPE_LAGS = {20: 5, 50: 10, 200: 20}
RETURN_PERIODS = {"1d": 1, "5d": 5, "20d": 20}
EWMA_LAMBDA = 0.94
ATR_WINDOW = 14
RANGE_WINDOW = 20
HISTORY_WINDOW = 252
TRADING_DAYS = 252
CORR_WINDOWS = (20, 60)

ANNUAL = math.sqrt(TRADING_DAYS)
EWMA_BLOCK = 2048
TREND_DEPTH = max(w + MA_SLOPE_LAGS[w] for w in MA_WINDOWS)

VOL_FEATURES = (
    *[f"realized_vol_{w}d" for w in VOL_WINDOWS],
    "realized_vol_5d_20d_ratio",
    "realized_vol_20d_60d_ratio",
    "ewma_vol",
    "atr_pct_14d",
    "realized_vol_20d_percentile_252d",
    "realized_vol_20d_zscore_252d",
    "parkinson_vol_20d",
    "garman_klass_vol_20d",
)
TREND_FEATURES = (
    *[f"distance_to_ma{w}" for w in MA_WINDOWS],
    *[f"ma{w}_slope_{MA_SLOPE_LAGS[w]}d" for w in MA_WINDOWS],
    "ma_alignment_score",
    "ma20_ma50_spread",
    "ma50_ma200_spread",
)
BREADTH_FEATURES = (
    "sector_observation_positive_return_1d_pct",
    "sector_observation_positive_return_5d_pct",
    *[f"sector_observation_above_ma{w}_pct" for w in MA_WINDOWS],
    "sector_observation_distance_to_ma20_avg",
    "sector_observation_distance_to_ma20_dispersion",
    "sector_observation_return_20d_dispersion",
)
CORR_FEATURES = ("return_corr_20d", "return_corr_60d", "return_corr_20d_60d_change")


def prepare_bars(bars: DataFrame, availability: str = "start", width_s: Column | None = None, strict: bool = True) -> DataFrame:
    """Upper-case symbols, finite prices and the time each bar becomes visible.

    A bar without a readable time stops the job; with ``strict`` off it is dropped.
    """
    if strict:
        told = F.raise_error(F.concat(F.lit("bar of "), F.coalesce("symbol", F.lit("?")), F.lit(" has no readable time"))).cast("timestamp_ntz")
        bars = bars.withColumn("ts", F.coalesce(F.col("ts").cast("timestamp_ntz"), told))
    else:
        bars = bars.where(F.col("ts").isNotNull())
    fixed = {c: finite(F.col(c).cast("double")) for c in ("bar_open", "bar_high", "bar_low", "bar_close")}
    return (
        bars.withColumns({"symbol": F.upper(F.trim("symbol")), **fixed})
        .where(F.col("symbol") != "")
        .withColumn("available_time", available_time(F.col("ts"), F.col("timeframe"), availability, width_s))
    )


def _trend(current: Column, ma: dict[int, Column], ma_before: dict[int, Column]) -> dict[str, Column]:
    """Distance, slope, alignment and spread features from moving averages."""
    out: dict[str, Column] = {}
    for w in MA_WINDOWS:
        out[f"distance_to_ma{w}"] = safe_div(current, ma[w]) - 1
    for w in MA_WINDOWS:
        out[f"ma{w}_slope_{MA_SLOPE_LAGS[w]}d"] = safe_div(ma[w], ma_before[w]) - 1
    out["ma_alignment_score"] = sign3(current - ma[20]) + sign3(ma[20] - ma[50]) + sign3(ma[50] - ma[200])
    out["ma20_ma50_spread"] = safe_div(ma[20], ma[50]) - 1
    out["ma50_ma200_spread"] = safe_div(ma[50], ma[200]) - 1
    return out


def daily_indicators(bars: DataFrame) -> DataFrame:
    """One row per daily bar with every single-symbol indicator as of that bar.

    Input: ``symbol, timeframe, ts, available_time, bar_open, bar_high, bar_low, bar_close``.
    Bars without close are no part of the history. ``idx`` counts closes, ``ret_idx``
    counts valid returns, ``bad`` counts non-positive closes, all up to the bar.
    """
    daily = bars.where(is_daily(F.col("timeframe")) & F.col("bar_close").isNotNull()).select(
        "symbol", "ts", "available_time", "bar_open", "bar_high", "bar_low", "bar_close"
    )
    w = Window.partitionBy("symbol").orderBy("available_time", "ts")
    c = F.col("bar_close")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)

    base = daily.withColumns(
        {
            "idx": F.row_number().over(w),
            "bad": F.sum(F.when(c <= 0, 1).otherwise(0)).over(upto),
            "prev_close": F.lag("bar_close").over(w),
            **{f"return_{k}": safe_log_ratio(c, F.lag("bar_close", n).over(w)) for k, n in RETURN_PERIODS.items()},
            "_hl": safe_log_ratio(F.col("bar_high"), F.col("bar_low")),
            "_co": safe_log_ratio(c, F.col("bar_open")),
        }
    )
    base = wide_mean(base, w, "bar_close", {f"ma{n}": n for n in MA_WINDOWS}, 10)
    base = base.withColumns({f"ma{n}": F.when(F.col("idx") >= n, F.col(f"ma{n}")) for n in MA_WINDOWS})
    h, low, pc = F.col("bar_high"), F.col("bar_low"), F.col("prev_close")
    whole_range = h.isNotNull() & low.isNotNull() & pc.isNotNull()
    gk = 0.5 * F.pow("_hl", F.lit(2)) - (2 * math.log(2) - 1) * F.pow("_co", F.lit(2))
    base = base.withColumns(
        {
            "_tr": F.when(whole_range, F.greatest(h - low, F.abs(h - pc), F.abs(low - pc))),
            "_hl2": F.pow("_hl", F.lit(2)),
            "_gk": gk,
        }
    )
    atr_w, rng_w = trailing(w, ATR_WINDOW), trailing(w, RANGE_WINDOW)
    parkinson = F.sqrt(F.sum("_hl2").over(rng_w) / (4 * RANGE_WINDOW * math.log(2))) * ANNUAL
    gk_mean = F.avg("_gk").over(rng_w)
    base = base.withColumns(
        {
            "atr_pct_14d": safe_div(
                full_window(F.avg("_tr").over(atr_w), F.col("_tr"), atr_w, ATR_WINDOW), c
            ),
            "parkinson_vol_20d": full_window(parkinson, F.col("_hl2"), rng_w, RANGE_WINDOW),
            "garman_klass_vol_20d": full_window(
                F.when(gk_mean >= 0, F.sqrt(gk_mean) * ANNUAL), F.col("_gk"), rng_w, RANGE_WINDOW
            ),
            **_trend(
                c,
                {n: F.col(f"ma{n}") for n in MA_WINDOWS},
                {n: F.lag(f"ma{n}", MA_SLOPE_LAGS[n]).over(w) for n in MA_WINDOWS},
            ),
        }
    ).drop("_hl", "_co", "_tr", "_hl2", "_gk")
    return _volatility(base)


def _volatility(base: DataFrame) -> DataFrame:
    """Volatility features over the compacted return series.

    Invalid returns are no part of the series: valid ones get their own window partition
    (still hashed by symbol, so no further shuffle) and other bars inherit the last state.
    """
    valid = F.col("return_1d").isNotNull()
    v = Window.partitionBy("symbol", valid).orderBy("available_time", "ts")
    steps = base.withColumn("ret_idx", F.when(valid, F.row_number().over(v)))
    steps = wide_moments(steps, v, "return_1d", {n: (f"_mean{n}", f"_var{n}") for n in VOL_WINDOWS}, 5)
    full = {
        f"realized_vol_{n}d": F.when(F.col("ret_idx") >= n, F.sqrt(F.col(f"_var{n}")) * ANNUAL) for n in VOL_WINDOWS
    }
    steps = steps.withColumns(full).drop(*[f"_{x}{n}" for n in VOL_WINDOWS for x in ("mean", "var")])
    steps = _vol_history(steps, v)
    steps = _ewma(steps, valid)
    carried = ["ret_idx", *[f"realized_vol_{n}d" for n in VOL_WINDOWS], "ewma_vol",
               "realized_vol_20d_percentile_252d", "realized_vol_20d_zscore_252d"]
    upto = Window.partitionBy("symbol").orderBy("available_time", "ts").rowsBetween(Window.unboundedPreceding, 0)
    inherited = {c: F.last(F.when(valid, F.struct(c)), ignorenulls=True).over(upto)[c] for c in carried}
    return (
        steps.withColumns(inherited)
        .withColumns(
            {
                "ret_idx": F.coalesce("ret_idx", F.lit(0)),
                "realized_vol_5d_20d_ratio": safe_div(F.col("realized_vol_5d"), F.col("realized_vol_20d")),
                "realized_vol_20d_60d_ratio": safe_div(F.col("realized_vol_20d"), F.col("realized_vol_60d")),
            }
        )
    )


def _vol_history(steps: DataFrame, v: WindowSpec) -> DataFrame:
    """Percentile and z-score of the 20-day volatility among its last 252 values."""
    name, part = "realized_vol_20d", 21
    parts = HISTORY_WINDOW // part
    whole = F.col("ret_idx") >= 20 + HISTORY_WINDOW - 1
    steps = wide_moments(steps, v, name, {HISTORY_WINDOW: ("_hist_mean", "_hist_var")}, part)
    steps = steps.withColumn("_list0", F.collect_list(name).over(trailing(v, part)))
    steps = steps.withColumns({f"_list{j}": F.lag("_list0", part * j).over(v) for j in range(1, parts)})
    below = F.lit(0)
    for j in range(parts):
        below = below + F.size(F.filter(f"_list{j}", lambda x: x <= F.col(name)))
    deviation = F.col(name) - F.col("_hist_mean")
    return steps.withColumns(
        {
            f"{name}_percentile_252d": F.when(whole, below / F.lit(float(HISTORY_WINDOW))),
            f"{name}_zscore_252d": F.when(whole, safe_div(deviation, F.sqrt(F.col("_hist_var")))),
        }
    ).drop("_hist_mean", "_hist_var", *[f"_list{j}" for j in range(parts)])


def _ewma(steps: DataFrame, valid: Column) -> DataFrame:
    """Exponentially weighted volatility without a row loop.

    v_n = sum of weights lambda^(n-j) times x_j is linear, so it is a running sum inside
    blocks of 2048 returns plus the decayed value carried over from the block before.
    """
    decay = F.lit(EWMA_LAMBDA)
    x = F.when(F.col("ret_idx") == 1, F.pow("return_1d", F.lit(2))).otherwise(
        (1 - EWMA_LAMBDA) * F.pow("return_1d", F.lit(2))
    )
    steps = steps.withColumns(
        {
            "_blk": F.floor((F.col("ret_idx") - 1) / EWMA_BLOCK),
            "_p": F.pmod(F.col("ret_idx") - 1, F.lit(EWMA_BLOCK)),
        }
    )
    inside = Window.partitionBy("symbol", valid, "_blk").orderBy("available_time", "ts")
    running = F.sum(x * F.pow(decay, -F.col("_p"))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    steps = steps.withColumn("_local", running * F.pow(decay, F.col("_p")))
    blocks = Window.partitionBy("symbol", valid).orderBy("available_time", "ts").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.collect_list(F.when(F.col("_p") == EWMA_BLOCK - 1, F.col("_local"))).over(blocks)
    carry = F.aggregate(ends, F.lit(0.0), lambda acc, e: acc * (EWMA_LAMBDA**EWMA_BLOCK) + e)
    variance = F.col("_local") + F.pow(decay, F.col("_p") + 1) * F.col("_carry")
    return (
        steps.withColumn("_carry", carry)
        .withColumn("ewma_vol", F.when(valid, F.sqrt(variance) * ANNUAL))
        .drop("_blk", "_p", "_local", "_carry")
    )


def return_series(indicators: DataFrame) -> DataFrame:
    """The compacted return series: symbol, idx, value."""
    return indicators.where(F.col("return_1d").isNotNull()).select(
        "symbol", F.col("ret_idx").alias("idx"), F.col("return_1d").alias("value")
    )


def close_series(indicators: DataFrame) -> DataFrame:
    return indicators.select("symbol", "idx", F.col("bar_close").alias("value"))


def corr(x: str, y: str) -> Column:
    """Pearson correlation of a group; null for fewer than two rows or zero variance."""
    both = F.when(F.count(F.lit(1)) >= 2, F.covar_pop(x, y))
    return safe_div(both, F.stddev_pop(x) * F.stddev_pop(y))


END = ("numerator", "denominator", "n_num", "n_den")


def pair_ends(visible: DataFrame, pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each snapshot and pair the visible state of both legs, as ``num_*`` / ``den_*``.

    A leg without any visible bar has null state.
    """
    legs = visible.select("snapshot_time", "symbol", *columns)
    num = legs.select(
        "snapshot_time", F.col("symbol").alias("numerator"), *[F.col(c).alias(f"num_{c}") for c in columns]
    )
    den = legs.select(
        "snapshot_time", F.col("symbol").alias("denominator"), *[F.col(c).alias(f"den_{c}") for c in columns]
    )
    return pairs.join(num, ["snapshot_time", "numerator"], "left").join(den, ["snapshot_time", "denominator"], "left")


def ratio_tail(ends: DataFrame, closes: DataFrame, valid_depth: int = TREND_DEPTH) -> DataFrame:
    """Tail-aligned positive close ratios; ``k`` = 0 is the last valid one.

    The look-back is widened by the number of non-positive closes in either leg, so
    dropped positions never shorten the window.
    """
    distinct = (
        ends.where(F.col("num_idx").isNotNull() & F.col("den_idx").isNotNull())
        .select("numerator", "denominator", F.col("num_idx").alias("n_num"), F.col("den_idx").alias("n_den"),
                F.col("num_bad").alias("b_num"), F.col("den_bad").alias("b_den"))
        .distinct()
    )
    depth = F.least(F.col("n_num"), F.col("n_den"), F.lit(valid_depth) + F.col("b_num") + F.col("b_den"))
    rows = tail_align(distinct, closes, depth).withColumn("ratio", safe_div(F.col("num_value"), F.col("den_value")))
    rows = rows.where(F.col("ratio") > 0)
    order = Window.partitionBy(*END).orderBy("k")
    return rows.select(*END, (F.row_number().over(order) - 1).alias("k"), "ratio").where(F.col("k") < valid_depth)


def aligned(wanted: DataFrame, series: DataFrame, back: Column | int) -> DataFrame:
    """Both legs' values side by side for each pair and offset: numerator, denominator, d, i, num_value, den_value.

    Aligning two series from their ends pairs position i of one with i - d of the other, where d is the difference of
    their lengths. ``wanted``: numerator, denominator, n_num, n_den; one row per pair, offset and day comes back,
    however many ends share it, from ``back`` positions before the first end that needs the offset.
    """
    spans = wanted.withColumns({"d": F.col("n_num") - F.col("n_den"), "_back": F.lit(back) if isinstance(back, int) else back})
    spans = spans.groupBy("numerator", "denominator", "d").agg(
        F.min(F.col("n_num") - F.col("_back")).alias("_from"), F.max("n_num").alias("_to"))
    num = series.select(F.col("symbol").alias("numerator"), F.col("idx").alias("i"), F.col("value").alias("num_value"))
    den = series.select(F.col("symbol").alias("denominator"), F.col("idx").alias("_j"), F.col("value").alias("den_value"))
    rows = spans.join(num, "numerator").where("i > _from AND i <= _to").withColumn("_j", F.col("i") - F.col("d"))
    return rows.join(den, ["denominator", "_j"]).select("numerator", "denominator", "d", "i", "num_value", "den_value")


def pair_trend(ends: DataFrame, closes: DataFrame) -> DataFrame:
    """Trend features and last-step return of the tail-aligned pair ratio, one row per distinct end.

    The ratio is laid out once per pair and offset; windows run over its positive values, other days inherit the
    last state, and ends look their day up.
    """
    distinct = (
        ends.where(F.col("num_idx").isNotNull() & F.col("den_idx").isNotNull())
        .select("numerator", "denominator", F.col("num_idx").alias("n_num"), F.col("den_idx").alias("n_den"),
                (F.lit(TREND_DEPTH) + F.col("num_bad") + F.col("den_bad")).alias("_depth"))
        .distinct()
    )
    rows = aligned(distinct, closes, F.col("_depth")).withColumn("ratio", safe_div(F.col("num_value"), F.col("den_value")))
    rows = rows.withColumn("_ok", F.coalesce(F.col("ratio") > 0, F.lit(False)))
    key = ["numerator", "denominator", "d"]
    w = Window.partitionBy(*key, "_ok").orderBy("i")
    rows = rows.withColumn("_n", F.row_number().over(w))
    rows = wide_mean(rows, w, "ratio", {f"ma{n}": n for n in MA_WINDOWS}, 10)
    rows = rows.withColumns({f"ma{n}": F.when(F.col("_n") >= n, F.col(f"ma{n}")) for n in MA_WINDOWS})
    rows = rows.withColumns({"_previous": F.lag("ratio").over(w), **{f"_before{n}": F.lag(f"ma{n}", MA_SLOPE_LAGS[n]).over(w) for n in MA_WINDOWS}})
    trend = _trend(F.col("ratio"), {n: F.col(f"ma{n}") for n in MA_WINDOWS}, {n: F.col(f"_before{n}") for n in MA_WINDOWS})
    state = F.struct(safe_log_ratio(F.col("ratio"), F.col("_previous")).alias("ratio_return_1d"), *[e.alias(n) for n, e in trend.items()])
    upto = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(*key, F.col("i").alias("n_num"), F.last(F.when(F.col("_ok"), state), ignorenulls=True).over(upto).alias("_s"))
    found = distinct.drop("_depth").withColumn("d", F.col("n_num") - F.col("n_den")).join(rows, [*key, "n_num"])
    return found.where(F.col("_s").isNotNull()).select(*END, "_s.*")


def return_corr(ends: DataFrame, returns: DataFrame) -> DataFrame:
    """Correlation of the last 20 and 60 returns of both legs, one row per distinct end.

    Each leg contributes its last ``window`` returns. Where both have that many, the pair's returns are laid out
    once per offset and windows run over them; where one is shorter the two lists are paired from their fronts.
    """
    distinct = (
        ends.where((F.col("num_ret_idx") > 0) & (F.col("den_ret_idx") > 0))
        .select("numerator", "denominator", F.col("num_ret_idx").alias("n_num"), F.col("den_ret_idx").alias("n_den"))
        .distinct()
    )
    longest, shortest = max(CORR_WINDOWS), F.least("n_num", "n_den")
    key = ["numerator", "denominator", "d"]
    rows = aligned(distinct.where(shortest >= min(CORR_WINDOWS)), returns, longest)
    w = Window.partitionBy(*key).orderBy("i")
    x, y = F.col("num_value"), F.col("den_value")

    def rolling_corr(n: int) -> Column:
        frame = trailing(w, n)
        c = safe_div(F.covar_pop(x, y).over(frame), F.stddev_pop(x).over(frame) * F.stddev_pop(y).over(frame))
        return F.when(F.count(F.lit(1)).over(frame) == n, c)

    rows = rows.select(*key, F.col("i").alias("n_num"), *[rolling_corr(n).alias(f"_w{n}") for n in CORR_WINDOWS])
    wide = distinct.withColumn("d", F.col("n_num") - F.col("n_den")).join(rows, [*key, "n_num"], "left").drop("d")

    # the first days of a leg: its whole list against the start of the other's window
    n, d, win = F.col("n_num"), F.col("n_den"), F.col("window")
    steps = distinct.where(shortest < longest).withColumn("window", F.explode(F.array(*[F.lit(c) for c in CORR_WINDOWS]))).where(shortest < win)
    steps = steps.withColumn("_k", F.explode(F.sequence(F.lit(1), F.least(n, d, win).cast("int"))))
    steps = steps.withColumns({"_i": F.greatest(n - win, F.lit(0)) + F.col("_k"), "_j": F.greatest(d - win, F.lit(0)) + F.col("_k")})
    num = returns.select(F.col("symbol").alias("numerator"), F.col("idx").alias("_i"), F.col("value").alias("x"))
    den = returns.select(F.col("symbol").alias("denominator"), F.col("idx").alias("_j"), F.col("value").alias("y"))
    per = steps.join(num, ["numerator", "_i"]).join(den, ["denominator", "_j"]).groupBy(*END, "window").agg(corr("x", "y").alias("c"))
    short = per.groupBy(*END).agg(*[F.max(F.when(win == c, F.col("c"))).alias(f"_s{c}") for c in CORR_WINDOWS])
    both = wide.join(short, list(END), "left")
    value = {c: F.when(shortest >= c, F.col(f"_w{c}")).otherwise(F.col(f"_s{c}")) for c in CORR_WINDOWS}
    out = both.select(*END, *[value[c].alias(f"return_corr_{c}d") for c in CORR_WINDOWS])
    return out.withColumn("return_corr_20d_60d_change", F.col("return_corr_20d") - F.col("return_corr_60d"))


def corr_concentration(pair_corr: DataFrame, by: Sequence[str] = ("snapshot_time",)) -> DataFrame:
    """Per snapshot (or epoch): mean, mean absolute and dispersion of all pair correlations."""
    cols = []
    for w in CORR_WINDOWS:
        c = F.col(f"return_corr_{w}d")
        cols += [
            F.avg(c).alias(f"market_state_avg_return_corr_{w}d"),
            F.avg(F.abs(c)).alias(f"market_state_avg_abs_return_corr_{w}d"),
            F.when(F.count(c) >= 2, F.stddev_pop(c)).alias(f"market_state_return_corr_dispersion_{w}d"),
        ]
    return pair_corr.groupBy(*by).agg(*cols)


def sector_breadth(visible: DataFrame, by: Sequence[str] = ("snapshot_time",)) -> DataFrame:
    """Per snapshot (or epoch): shares of symbols rising and above their averages, and dispersion.

    A symbol without enough history is not in the denominator.
    """

    def share(cond: Column) -> Column:
        return F.avg(cond.cast("double"))

    dist = F.when(F.col("ma20").isNotNull(), F.col("bar_close") / F.col("ma20") - 1)
    r20 = F.col("return_20d")
    return visible.groupBy(*by).agg(
        share(F.col("return_1d") > 0).alias("sector_observation_positive_return_1d_pct"),
        share(F.col("return_5d") > 0).alias("sector_observation_positive_return_5d_pct"),
        *[share(F.col("bar_close") > F.col(f"ma{w}")).alias(f"sector_observation_above_ma{w}_pct") for w in MA_WINDOWS],
        F.avg(dist).alias("sector_observation_distance_to_ma20_avg"),
        F.when(F.count(dist) >= 2, F.stddev_pop(dist)).alias("sector_observation_distance_to_ma20_dispersion"),
        F.when(F.count(r20) >= 2, F.stddev_pop(r20)).alias("sector_observation_return_20d_dispersion"),
    )
