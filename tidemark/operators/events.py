"""Detection of abnormal equity and option activity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import fmt6, safe_div, whole_number
from ..functions.quotes import ask_touch_ratio, price_vs_ask
from ..functions.symbols import activity_summary, contract_symbol, event_headline, event_id_equity
from ..functions.times import WIDTHS, iso_et, tumbling
from .joins import enrich
from .windows import rolling, trailing_z

# Default thresholds of the equity detector.
EQUITY_DEFAULTS = {
    "lookback_intervals": 20,
    "min_abs_return_zscore": 3.0,
    "min_volume_zscore": 3.0,
    "min_abs_relative_strength_zscore": 3.0,
    "min_abs_gap_pct": 0.04,
    "min_liquidity_spread_zscore": 3.0,
    "model_standard": "equity_abnormal_activity_v0",
}


def _order(bars: DataFrame) -> list[str]:
    return ["ts", *(c for c in ("arrival",) if c in bars.columns)]


def simple_returns(bars: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Close-to-close return and opening gap; rows without time or close are skipped entirely.

    Bars of one time follow each other by ``arrival``, if there is such a column.
    """
    rows = bars.where(F.col("ts").isNotNull() & F.col("bar_close").isNotNull())

    def step(w) -> dict[str, Column]:
        return {"prev_close": F.lag("bar_close").over(w)}

    out = rolling(rows, list(by), "ts", _order(rows), 1, step)
    return out.withColumns(
        {
            "ret": safe_div(F.col("bar_close"), F.col("prev_close")) - 1,
            "gap": safe_div(F.col("bar_open"), F.col("prev_close")) - 1,
        }
    )


def equity_measures(
    bars: DataFrame, benchmark: DataFrame | None = None, liquidity: DataFrame | None = None, lookback: int = 20
) -> DataFrame:
    """Bars with return, gap, relative return, spread and the trailing z-score of each.

    ``benchmark``: bars (ts, bar_close) of one instrument. ``liquidity``: symbol, ts, avg_spread.
    """
    rows = simple_returns(bars)
    if benchmark is not None:
        bench = simple_returns(benchmark.withColumn("_one", F.lit(1)).select("_one", "ts", "bar_close", F.lit(None).cast("double").alias("bar_open")), ["_one"])
        bench = bench.where(F.col("ret").isNotNull()).select("ts", F.col("ret").alias("benchmark_ret"))
        rows = enrich(rows, bench, ["ts"], ["benchmark_ret"])
    else:
        rows = rows.withColumn("benchmark_ret", F.lit(None).cast("double"))
    if liquidity is not None:
        last = [c for c in ("arrival",) if c in liquidity.columns]
        liq = liquidity.select("symbol", "ts", F.col("avg_spread").alias("spread"), F.lit(True).alias("has_liquidity"), *last)
        rows = enrich(rows, liq, ["symbol", "ts"], ["spread", "has_liquidity"], last)
    else:
        rows = rows.withColumns({"spread": F.lit(None).cast("double"), "has_liquidity": F.lit(None).cast("boolean")})
    rows = rows.withColumns(
        {
            "relative": F.col("ret") - F.col("benchmark_ret"),
            "volume": F.col("bar_volume").cast("double"),
            "has_liquidity": F.coalesce("has_liquidity", F.lit(False)),
        }
    )
    return trailing_z(rows, ["symbol"], "ts", _order(rows), ["ret", "volume", "relative", "spread"], lookback)


def detect_equity_events(
    bars: DataFrame,
    benchmark: DataFrame | None = None,
    liquidity: DataFrame | None = None,
    bar_reference: str = "equity_bar",
    liquidity_reference: str = "equity_liquidity_bar",
    source_type: str = "equity_market_data",
    **overrides,
) -> DataFrame:
    """One row per bar on which at least one indicator is abnormal."""
    p = {**EQUITY_DEFAULTS, **overrides}
    m = equity_measures(bars, benchmark, liquidity, int(p["lookback_intervals"]))
    checks = (
        ("return_zscore", F.abs("ret_z") >= p["min_abs_return_zscore"]),
        ("volume_spike", F.col("volume_z") >= p["min_volume_zscore"]),
        ("sector_relative_move", F.abs("relative_z") >= p["min_abs_relative_strength_zscore"]),
        ("gap", F.abs("gap") >= p["min_abs_gap_pct"]),
        ("liquidity_spread", F.col("spread_z") >= p["min_liquidity_spread_zscore"]),
    )
    m = m.withColumn("activity", F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks])))
    symbol, at = F.upper("symbol"), iso_et(F.col("ts"))
    ref = F.concat(symbol, F.lit(":"), at)
    refs = F.array_compact(
        F.array(
            F.concat(F.lit(f"{bar_reference}:"), ref),
            F.when(F.col("has_liquidity"), F.concat(F.lit(f"{liquidity_reference}:"), ref)),
            F.when(F.col("benchmark_ret").isNotNull(), F.concat(F.lit("benchmark_return:"), at)),
        )
    )
    evidence = F.to_json(
        F.struct(at.alias("event_time"), F.lit(int(p["lookback_intervals"])).alias("lookback_intervals"), F.col("timeframe"))
    )
    taxonomy = F.to_json(
        F.struct(F.col("benchmark_ret").isNotNull().alias("benchmark_present"), F.lit(p["model_standard"]).alias("detector"))
    )
    return m.where(F.size("activity") > 0).select(
        event_id_equity(symbol, at).alias("event_id"),
        symbol.alias("symbol"),
        at.alias("event_time"),
        at.alias("effective_time"),
        F.lit("equity_abnormal_activity_event").alias("event_type"),
        F.lit(source_type).alias("source_type"),
        F.concat(symbol, F.lit(" abnormal equity activity")).alias("title"),
        activity_summary(symbol, F.col("activity"), F.col("timeframe")).alias("summary"),
        F.array_join("activity", ";").alias("abnormal_activity_type"),
        evidence.alias("evidence_window"),
        fmt6(F.col("ret_z")).alias("return_zscore"),
        fmt6(F.col("volume_z")).alias("volume_zscore"),
        fmt6(F.col("relative_z")).alias("relative_strength_zscore"),
        fmt6(F.col("gap")).alias("gap_pct"),
        fmt6(F.col("spread_z")).alias("liquidity_spread_zscore"),
        F.array_join(refs, ";").alias("source_references"),
        taxonomy.alias("taxonomy_context"),
    )


# --------------------------------------------------------------------------- options


def at_ask(price: Column, bid: Column, ask: Column, standard: Mapping[str, float]) -> Column:
    """Trade printed at or near the ask; an absent threshold does not restrict."""
    distance, touch = price_vs_ask(price, ask), ask_touch_ratio(price, bid, ask)
    ok = distance.isNotNull() & touch.isNotNull()
    if standard.get("max_price_vs_ask") is not None:
        ok = ok & (distance <= float(standard["max_price_vs_ask"]))
    if standard.get("min_ask_touch_ratio") is not None:
        ok = ok & (touch >= float(standard["min_ask_touch_ratio"]))
    return F.coalesce(ok, F.lit(False))


def _at_least(checks: list[tuple[Column, float | None]]) -> Column:
    """All set thresholds reached; at least one must be set; a missing measure fails."""
    active = [(value, float(limit)) for value, limit in checks if limit is not None]
    if not active:
        return F.lit(False)
    ok = F.lit(True)
    for value, limit in active:
        ok = ok & F.coalesce(value >= limit, F.lit(False))
    return ok


def opening_activity(volume: Column, percentile: Column, standard: Mapping[str, float]) -> Column:
    return _at_least(
        [(volume, standard.get("min_window_volume")), (percentile, standard.get("min_volume_percentile_20d_same_time"))]
    )


def iv_high(percentile: Column, zscore: Column, standard: Mapping[str, float]) -> Column:
    return _at_least(
        [(percentile, standard.get("min_iv_percentile_by_expiration")), (zscore, standard.get("min_iv_zscore_by_expiration"))]
    )


def window_stats(
    trades: DataFrame, width: str, keys: Sequence[str], ts: str = "ts", seq: str = "seq",
    ask_standard: Mapping[str, float] | None = None,
) -> DataFrame:
    """Per key and window: counts, volume, notional, prior volume, and the trade that speaks for it.

    The trade is the first at the ask, else the largest (first on ties). Everything is one
    decomposable aggregation; only the prior-window look-back orders the windows of a key.
    """
    size = whole_number(F.col("size"))
    ticks = tumbling(trades.where(F.col(ts).isNotNull()), ts, width).withColumns(
        {"_size": size, "_order": F.struct(F.col(ts), F.col(seq))}
    )
    hit = F.lit(False) if ask_standard is None else at_ask(F.col("price"), F.col("bid"), F.col("ask"), ask_standard)
    fields = [c for c in (ts, "quote_ts", "price", "bid", "ask") if c in trades.columns]
    trade = F.struct(*[F.col(c) for c in fields], F.col("_size").alias("size"))
    # largest size wins; among equals the smallest position, so positions are compared reversed
    back = F.struct(F.col("_size"), -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts)), -F.col(seq))
    stats = ticks.groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("window_trade_count"),
        F.sum("_size").alias("window_volume"),
        F.sum(F.coalesce(F.col("price"), F.lit(0.0)) * F.col("_size")).alias("window_notional"),
        F.coalesce(F.min_by(trade, F.when(hit, F.col("_order"))), F.max_by(trade, back)).alias("trade"),
        F.max(hit).alias("has_ask_trade"),
    )
    order = Window.partitionBy(*keys).orderBy("bucket")
    prior = F.lag("window_volume", 1, 0).over(order)
    return stats.withColumn("contract_prior_window_volume", prior).withColumns(
        {
            "first_seen_in_window": F.col("contract_prior_window_volume") == 0,
            "volume_vs_prior_window_ratio": safe_div(
                F.col("window_volume").cast("double"), F.col("contract_prior_window_volume").cast("double")
            ),
        }
    )


def detect_option_events(
    trades: DataFrame,
    standards: Mapping[str, Mapping[str, float]],
    width: str = "30Min",
    keys: Sequence[str] = ("underlying", "expiration", "option_right_type", "strike"),
    iv: DataFrame | None = None,
    max_events: int | None = None,
    standard_context: Mapping[str, str] | None = None,
    provider: str = "option_trade_quote",
) -> DataFrame:
    """Windows of option trades that meet at least one standard; with ``max_events``, the first so many per contract.

    ``standards`` holds any of ``trade_at_ask``, ``opening_activity``, ``iv_high_cross_section``.
    ``iv``: keys, implied_vol, iv_percentile_by_expiration, iv_zscore_by_expiration.
    Nested evidence comes as struct columns; :func:`event_detail_rows` flattens it to JSON.
    """
    context = dict(standard_context or {})
    w = window_stats(trades, width, keys, ask_standard=standards.get("trade_at_ask"))
    if iv is not None:
        w = w.join(iv, list(keys), "left")
    else:
        w = w.withColumns(
            {c: F.lit(None).cast("double") for c in ("implied_vol", "iv_percentile_by_expiration", "iv_zscore_by_expiration")}
        )
    never = F.lit(False)
    checks = {
        "trade_at_ask": F.col("has_ask_trade") if "trade_at_ask" in standards else never,
        "opening_activity": opening_activity(F.col("window_volume"), F.lit(None).cast("double"), standards["opening_activity"])
        if "opening_activity" in standards else never,
        "iv_high_cross_section": iv_high(
            F.col("iv_percentile_by_expiration"), F.col("iv_zscore_by_expiration"), standards["iv_high_cross_section"]
        ) if "iv_high_cross_section" in standards else never,
    }
    w = w.withColumn("triggered", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()])))
    w = w.where(F.size("triggered") > 0)
    if max_events is not None:
        first = Window.partitionBy(*keys).orderBy("bucket")
        w = w.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= max_events)

    t = {c: F.col(f"trade.{c}") for c in ("ts", "price", "bid", "ask", "size")}
    contract = contract_symbol(F.col("underlying"), F.col("expiration"), F.col("strike"), F.col("option_right_type"))
    created = iso_et(F.coalesce(t["ts"], F.col("bucket")))
    updated = F.lit(context["generated_at"]) if context.get("generated_at") else created
    ident = F.concat(F.lit("opt_evt_"), F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col("bucket").cast("string"))))
    quote_ts = iso_et(F.col("trade.quote_ts")) if "quote_ts" in trades.columns else F.lit(None).cast("string")

    def limits(name: str) -> Column:
        return F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in standards[name].items()])) if name in standards else F.lit(None).cast("string")

    def when_on(name: str, value: Column) -> Column:
        return F.when(F.array_contains("triggered", name), value)

    indicators = F.struct(
        when_on("trade_at_ask", F.struct(
            F.struct(t["price"].alias("trade_price"), price_vs_ask(t["price"], t["ask"]).alias("price_vs_ask"),
                     ask_touch_ratio(t["price"], t["bid"], t["ask"]).alias("ask_touch_ratio"),
                     t["bid"].alias("bid"), t["ask"].alias("ask"), ((t["bid"] + t["ask"]) / 2).alias("mid")).alias("statistics"),
            limits("trade_at_ask").alias("current_standard"))).alias("trade_at_ask"),
        when_on("opening_activity", F.struct(
            F.struct("window_trade_count", "window_volume", "window_notional", "first_seen_in_window",
                     "contract_prior_window_volume", "volume_vs_prior_window_ratio").alias("statistics"),
            limits("opening_activity").alias("current_standard"))).alias("opening_activity"),
        when_on("iv_high_cross_section", F.struct(
            F.struct("implied_vol", "iv_percentile_by_expiration", "iv_zscore_by_expiration").alias("statistics"),
            limits("iv_high_cross_section").alias("current_standard"))).alias("iv_high_cross_section"),
    )
    seconds = WIDTHS[width]
    return w.select(
        ident.alias("event_id"),
        event_headline(contract, F.col("triggered")).alias("timeline_headline"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.concat(F.col("underlying"), F.lit(";"), contract).alias("symbols"),
        F.array_join("triggered", ";").alias("summary"),
        F.concat(ident, F.lit(".csv")).alias("event_link_url"),
        *keys,
        contract.alias("contract_symbol"),
        "bucket",
        indicators.alias("triggered_indicators"),
        F.struct(
            F.lit(width).alias("timeframe"),
            iso_et(F.col("bucket")).alias("window_start"),
            iso_et(F.timestamp_add("SECOND", F.lit(seconds), F.col("bucket"))).alias("window_end"),
        ).alias("evidence_window"),
        F.struct(
            when_on("trade_at_ask", F.lit("ask_side")).alias("trade_side_type"),
            created.alias("trade_timestamp"),
            t["price"].alias("trade_price"),
            t["size"].alias("trade_size"),
        ).alias("triggering_trade"),
        F.struct(
            quote_ts.alias("timestamp"),
            t["bid"].alias("bid"),
            t["ask"].alias("ask"),
            ((t["bid"] + t["ask"]) / 2).alias("mid"),
            (t["ask"] - t["bid"]).alias("spread"),
        ).alias("quote_context"),
        F.struct("implied_vol", "iv_percentile_by_expiration", "iv_zscore_by_expiration").alias("iv_context"),
        F.struct(
            F.lit(context.get("standard_source", "task_key_current_standard")).alias("standard_source"),
            F.lit(context.get("standard_id")).cast("string").alias("standard_id"),
            F.lit(context.get("generated_at")).cast("string").alias("generated_at"),
        ).alias("standard_context"),
        F.struct(F.lit(provider).alias("provider"), F.lit("not_persisted_by_default").alias("raw_persistence")).alias("source_references"),
    )


TIMELINE_COLUMNS = ("timeline_headline", "created_at", "updated_at", "symbols", "summary", "event_link_url")
DETAIL_JSON = ("triggered_indicators", "evidence_window", "triggering_trade", "quote_context", "iv_context", "source_references")


def event_timeline(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("id"), *TIMELINE_COLUMNS)


def event_detail_rows(events: DataFrame) -> DataFrame:
    """Flat detail rows: nested evidence as JSON text."""
    return events.select(
        "event_id", "created_at", "updated_at", "underlying", "expiration", "option_right_type", "strike",
        "contract_symbol", *[F.to_json(c).alias(c) for c in DETAIL_JSON],
    )
