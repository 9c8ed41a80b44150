"""Point-in-time feature tables, kept long: one row per (snapshot, feature)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import safe_div, safe_log_ratio
from ..operators.indicators import (
    BREADTH_FEATURES,
    CORR_FEATURES,
    END,
    MA_WINDOWS,
    TREND_FEATURES,
    VOL_FEATURES,
    close_series,
    corr_concentration,
    daily_indicators,
    pair_trend,
    return_corr,
    return_series,
    sector_breadth,
)
from ..operators.epochs import Grid, common_epochs, epochs, expand, merged, pair_epochs, snapshot_grid
from ..operators.joins import pairwise_symbols
from ..shared import staged
from ..sources.sinks import upsert_path

# Names that steer which feature goes where.
MARKET_STATE = "market_state_etf"
SECTOR_OBSERVATION = "sector_observation_etf"
ROTATION_TYPES = ("sector_rotation", "daily_context")
RETURN_TREND_EXCLUDED = ("SHY",)
SUMMARY_ROW = {
    "candidate_symbol": "SECTOR_OBSERVATION_UNIVERSE",
    "candidate_type": "sector_rotation_summary",
    "comparison_symbol": "MARKET",
    "rotation_pair_id": "sector_observation_breadth",
    "rotation_pair_type": "sector_rotation_summary",
    "feature_bar_grain": "mixed",
}
ROTATION_META = (
    "snapshot_time", "candidate_symbol", "candidate_type", "comparison_symbol", "rotation_pair_id",
    "rotation_pair_type", "feature_bar_grain",
)
PAIR_COLUMNS = ("combination_id", "combination_type", "numerator", "denominator", "feature_bar_grain")
LAG_MINUTES = 30
PAIR_PREFIX = "relative_strength_"
PAIR_VALUES = ("return", "realized_vol_20d_ratio", *TREND_FEATURES, *CORR_FEATURES)


def normalize_pairs(rows: DataFrame) -> DataFrame:
    """Reviewed pair list: ids and types lower, symbols upper, incomplete rows dropped."""

    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))

    return rows.select(
        F.lower(text("combination_id")).alias("combination_id"),
        F.lower(text("combination_type")).alias("combination_type"),
        F.upper(text("numerator_symbol")).alias("numerator"),
        F.upper(text("denominator_symbol")).alias("denominator"),
        F.lower(text("feature_bar_grain")).alias("feature_bar_grain"),
    ).where((F.col("combination_id") != "") & (F.col("numerator") != "") & (F.col("denominator") != ""))


def symbols_of(universe: DataFrame, universe_type: str) -> DataFrame:
    return (
        universe.where((F.trim("universe_type") == universe_type) & (F.trim("symbol") != ""))
        .select(F.upper(F.trim("symbol")).alias("symbol"))
        .distinct()
    )


def infer_snapshots(bars: DataFrame, anchor: str = "SPY") -> DataFrame:
    """Distinct half-hour marks after 09:30 up to 16:00 at which the anchor has an intraday bar."""
    from ..functions.times import is_daily

    at = F.col("available_time")
    sod = F.hour(at) * 3600 + F.minute(at) * 60
    whole = (F.timestamp_diff("MICROSECOND", F.to_date(at).cast("timestamp_ntz"), at) == sod.cast("bigint") * 1_000_000)
    return (
        bars.where((F.col("symbol") == anchor.upper()) & ~is_daily(F.col("timeframe")))
        .where(whole & F.minute(at).isin(0, 30) & (sod > 9 * 3600 + 1800) & (sod <= 16 * 3600))
        .select(at.alias("snapshot_time"))
        .distinct()
    )


def mark_epochs(bars: DataFrame, symbols: DataFrame, grid: Grid) -> DataFrame:
    """Epochs of each listed symbol's latest close over all bar widths, now and 30 minutes before.

    What was visible 30 minutes before a snapshot is what becomes visible 30 minutes late.
    """
    closes = bars.where(F.col("bar_close").isNotNull()).select("symbol", "available_time", "ts", "bar_close")
    lag = F.explode(F.array(F.lit(0), F.lit(LAG_MINUTES))).alias("lag")
    both = closes.select("*", lag).withColumn("available_time", F.timestamp_add("MINUTE", F.col("lag"), F.col("available_time")))
    listed = symbols.select("symbol", lag)
    found = epochs(both, grid, ["symbol", "lag"], ["bar_close"], listed=listed)
    legs = [(found.where(F.col("lag") == minutes), {"bar_close": name}) for minutes, name in ((0, "close_now"), (LAG_MINUTES, "close_before"))]
    return merged(legs, ["symbol"], grid)


SPAN = ("first_no", "last_no")
BAR_COLUMNS = ("symbol", "timeframe", "ts", "available_time", "bar_open", "bar_high", "bar_low", "bar_close")


def melt(df: DataFrame, ids: Iterable[str], values: dict[str, Column | str], prefix: Column | None = None) -> DataFrame:
    """Fold columns to rows (ids..., feature, value); ``prefix`` is put before each feature name."""
    items = F.array(*[
        F.struct(F.lit(n).alias("feature"), (F.col(v) if isinstance(v, str) else v).cast("double").alias("value"))
        for n, v in values.items()
    ])
    name = F.col("_f.feature") if prefix is None else F.concat("_prefix", "_f.feature")
    kept = [*ids] if prefix is None else [*ids, prefix.alias("_prefix")]
    return df.select(*kept, F.explode(items).alias("_f")).select(*ids, name.alias("feature"), "_f.value")


def legs_of(pairs: DataFrame) -> DataFrame:
    """The distinct symbols of a pair list."""
    return pairs.select(F.col("numerator").alias("symbol")).unionByName(pairs.select(F.col("denominator").alias("symbol"))).distinct()


def relative_strength(pairs: DataFrame, marks: DataFrame, daily: DataFrame, grid: Grid) -> DataFrame:
    """Spans of each pair's ``relative_strength_return``.

    A pair of 30-minute grain compares the marks of its legs now and 30 minutes before; any other takes the last step of
    the daily ratio. ``daily``: pair spans with ratio_return_1d.
    """
    fast = F.col("feature_bar_grain").eqNullSafe("30m")
    both = pair_epochs(marks, pairs.where(fast), PAIR_COLUMNS, ["close_now", "close_before"], grid)
    now = safe_div(F.col("num_close_now"), F.col("den_close_now"))
    before = safe_div(F.col("num_close_before"), F.col("den_close_before"))
    moved = both.select(*PAIR_COLUMNS, *SPAN, safe_log_ratio(now, before).alias("relative_strength_return"))
    stepped = daily.where(~fast).select(*PAIR_COLUMNS, *SPAN, F.col("ratio_return_1d").alias("relative_strength_return"))
    return moved.unionByName(stepped)


def pair_spans(
    pairs: DataFrame, states: DataFrame, indicators: DataFrame, grid: Grid, wanted: Iterable[str] = (*TREND_FEATURES, *CORR_FEATURES)
) -> DataFrame:
    """Spans of the pair features that follow daily bars: volatility ratio, last ratio step and trend, correlation.

    ``states``: epochs of the daily indicators by symbol, ``indicators`` the bars they come from. ``wanted``: trend and
    correlation are left out where none of their features is named.
    """
    wanted = set(wanted)
    ends = staged(pair_epochs(states, pairs, PAIR_COLUMNS, ["idx", "bad", "ret_idx", "realized_vol_20d"], grid), "ends")
    ratio = safe_div(F.col("num_realized_vol_20d"), F.col("den_realized_vol_20d")).alias("realized_vol_20d_ratio")
    keyed, found = ends, []
    if wanted & {"ratio_return_1d", *TREND_FEATURES}:
        trend = pair_trend(ends, close_series(indicators))
        keyed = keyed.withColumns({"n_num": F.col("num_idx"), "n_den": F.col("den_idx")}).join(trend, list(END), "left")
        found += ["ratio_return_1d", *TREND_FEATURES]
    if wanted & set(CORR_FEATURES):
        corr = return_corr(ends, return_series(indicators))
        keyed = keyed.withColumns({"n_num": F.col("num_ret_idx"), "n_den": F.col("den_ret_idx")}).join(corr, list(END), "left")
        found += CORR_FEATURES
    return keyed.select(*PAIR_COLUMNS, *SPAN, ratio, *found)


def concentration(symbols: DataFrame, states: DataFrame, indicators: DataFrame, grid: Grid) -> DataFrame:
    """Spans of the correlation concentration over all pairs of the listed symbols; they cover all snapshots."""
    pairs = pairwise_symbols(symbols).select(
        F.col("left_symbol").alias("numerator"), F.col("right_symbol").alias("denominator")
    )
    ends = staged(common_epochs(pair_epochs(states, pairs, ["numerator", "denominator"], ["ret_idx"], grid), []), "state-ends")
    corr = return_corr(ends, return_series(indicators))
    per_pair = ends.withColumns({"n_num": F.col("num_ret_idx"), "n_den": F.col("den_ret_idx")}).join(corr, list(END), "left")
    found = corr_concentration(per_pair, SPAN)
    return merged([(found, {c: c for c in found.columns if c not in SPAN})], [], grid, listed=all_snapshots(grid))


def breadth(states: DataFrame, grid: Grid) -> DataFrame:
    """Spans of the breadth over all symbols of ``states``; they cover all snapshots."""
    found = sector_breadth(common_epochs(states.where(F.col("idx").isNotNull()), []), SPAN)
    return merged([(found, {c: c for c in BREADTH_FEATURES})], [], grid, listed=all_snapshots(grid))


def all_snapshots(grid: Grid) -> DataFrame:
    """One row if there is any snapshot."""
    return grid.numbers.where("no = 0").select("no")


def regime_spans(
    bars: DataFrame, universe: DataFrame, pairs: DataFrame, grid: Grid, excluded: Iterable[str] = RETURN_TREND_EXCLUDED
) -> DataFrame:
    """Market-regime features by epoch: (first_no, last_no, feature, value), nulls kept.

    Of each feature the spans cover all snapshots of the grid without overlap. ``bars`` come from ``prepare_bars``; ``pairs``
    from :func:`normalize_pairs`.
    """
    states = symbols_of(universe, MARKET_STATE)
    own_pairs = pairs.where(~F.col("combination_type").isin(*ROTATION_TYPES))
    bars = staged(bars.select(*BAR_COLUMNS), "bars")
    indicators = staged(daily_indicators(bars), "indicators")
    symbols = states.unionByName(legs_of(own_pairs)).distinct()
    columns = [c for c in indicators.columns if c not in ("symbol", "available_time", "ts")]
    seen = staged(epochs(indicators, grid, ["symbol"], columns, listed=symbols), "epochs")
    marks = staged(mark_epochs(bars, symbols, grid), "marks")

    subject = F.concat(F.lower("symbol"), F.lit("_"))
    in_trend = ~F.col("symbol").isin(*excluded)
    own = seen.join(states, "symbol", "left_semi")
    vols = melt(own, SPAN, {f: f for f in VOL_FEATURES}, subject)
    moves = {f: f for f in ("return_1d", "return_5d", "return_20d", *TREND_FEATURES)}
    trends = melt(own.where(in_trend), SPAN, moves, subject)
    quick = marks.join(states, "symbol", "left_semi").where(in_trend)
    quick = melt(quick, SPAN, {"return_30m": safe_log_ratio(F.col("close_now"), F.col("close_before"))}, subject)

    daily = staged(pair_spans(own_pairs, seen, indicators, grid), "pairs")
    pid = F.concat(F.col("combination_id"), F.lit("_"))
    grain = F.when(F.col("feature_bar_grain") == "30m", F.lit("30m")).otherwise(F.lit("1d"))
    pair_rows = melt(daily, SPAN, {f: f for f in ("realized_vol_20d_ratio", *TREND_FEATURES, *CORR_FEATURES)}, pid)
    strength = relative_strength(own_pairs, marks, daily, grid).select(
        *SPAN, F.concat(pid, grain).alias("feature"), F.col("relative_strength_return").alias("value")
    )
    conc = concentration(states, seen, indicators, grid)
    out = melt(conc, SPAN, {n: n for n in conc.columns if n not in SPAN})
    for part in (vols, trends, quick, pair_rows, strength):
        out = out.unionByName(part)
    return out


def regime_features(
    bars: DataFrame, universe: DataFrame, pairs: DataFrame, snapshots: DataFrame, excluded: Iterable[str] = RETURN_TREND_EXCLUDED
) -> DataFrame:
    """Market-regime features at every snapshot: (snapshot_time, feature, value), nulls kept."""
    grid = snapshot_grid(snapshots)
    return expand(regime_spans(bars, universe, pairs, grid, excluded), grid)


META = tuple(c for c in ROTATION_META if c != "snapshot_time")


def rotation_spans(
    bars: DataFrame, universe: DataFrame, pairs: DataFrame, grid: Grid, only: Iterable[str] | None = None
) -> DataFrame:
    """Rotation features by epoch: metadata columns, first_no, last_no, feature, value; one summary group and one per rotation pair.

    ``only``: the wanted feature names; nothing else is computed.
    """
    wanted = None if only is None else set(only)
    own_pairs = pairs.where(F.col("combination_type").isin(*ROTATION_TYPES))
    bars = staged(bars.select(*BAR_COLUMNS), "bars")
    observed, legs = symbols_of(universe, SECTOR_OBSERVATION), legs_of(own_pairs)
    columns = ["idx", "bad", "ret_idx", "realized_vol_20d", "bar_close", "return_1d", "return_5d", "return_20d", *[f"ma{w}" for w in MA_WINDOWS]]
    indicators = staged(daily_indicators(bars).select("symbol", "ts", "available_time", *columns), "indicators")
    seen = staged(epochs(indicators, grid, ["symbol"], columns, listed=observed.unionByName(legs).distinct()), "epochs")

    names = [c for c in BREADTH_FEATURES if wanted is None or c in wanted]
    summary = None
    if names:
        rows = breadth(seen.join(observed, "symbol", "left_semi"), grid)
        summary = melt(rows.withColumns({k: F.lit(v) for k, v in SUMMARY_ROW.items()}), [*META, *SPAN], {n: n for n in names})

    stripped = None if wanted is None else {n.removeprefix(PAIR_PREFIX) for n in wanted}
    needs_step = stripped is None or any(n.startswith("return") and n not in CORR_FEATURES for n in stripped)
    needed = (*TREND_FEATURES, *CORR_FEATURES) if stripped is None else [*stripped, *(["ratio_return_1d"] if needs_step else [])]
    daily = staged(pair_spans(own_pairs, seen, indicators, grid, needed), "pairs")
    about = [
        F.col("numerator").alias("candidate_symbol"), F.lit("sector_industry_etf").alias("candidate_type"), F.col("denominator").alias("comparison_symbol"),
        F.col("combination_id").alias("rotation_pair_id"), F.col("combination_type").alias("rotation_pair_type"), "feature_bar_grain",
    ]
    plain = {f: f"{PAIR_PREFIX}{f}" for f in PAIR_VALUES if f != "return"}
    plain = {f: n for f, n in plain.items() if wanted is None or n in wanted}
    rows = melt(daily.select(*about, *SPAN, *plain), [*META, *SPAN], {f: f for f in plain}, F.lit(PAIR_PREFIX)) if plain else None
    grain = F.concat(F.lit(f"{PAIR_PREFIX}return_"), F.when(F.col("feature_bar_grain") == "30m", F.lit("30m")).otherwise(F.lit("1d")))
    strength = None
    if needs_step:
        marks = staged(mark_epochs(bars, legs, grid), "marks")
        both = F.explode(F.array(F.lit(f"{PAIR_PREFIX}return"), grain)).alias("feature")
        strength = relative_strength(own_pairs, marks, daily, grid).select(*about, *SPAN, both, F.col("relative_strength_return").alias("value"))
        strength = strength if wanted is None else strength.where(F.col("feature").isin(*wanted))
    parts = [part for part in (summary, rows, strength) if part is not None]
    if not parts:
        raise ValueError(f"no such rotation features: {sorted(wanted or ())}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*META, *SPAN, "feature", "value")


def rotation_features(
    bars: DataFrame, universe: DataFrame, pairs: DataFrame, snapshots: DataFrame, only: Iterable[str] | None = None
) -> DataFrame:
    """Rotation features at every snapshot: metadata columns, feature, value."""
    grid = snapshot_grid(snapshots)
    return expand(rotation_spans(bars, universe, pairs, grid, only), grid).select(*ROTATION_META, "feature", "value")


SIGNAL_FEATURES = ("relative_strength_return", "relative_strength_distance_to_ma20", "relative_strength_ma_alignment_score")


def signal_average(features: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Mean of the non-null among three relative-strength features."""
    return (
        features.where(F.col("feature").isin(*SIGNAL_FEATURES))
        .groupBy(*keys)
        .agg(F.avg("value").alias("signal_average"))
    )


def payload_columns(features: DataFrame) -> DataFrame:
    """Sorted distinct feature names."""
    return features.select("feature").distinct().orderBy("feature")


def fold_payload(features: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Long features to one row per key with a sorted JSON payload; null values stay."""
    for key in keys:
        if key not in features.columns:
            raise ValueError(f"feature rows must include {key}")
    entries = F.sort_array(F.collect_list(F.struct("feature", "value")))
    payload = F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"})
    return features.groupBy(*keys).agg(payload.alias("feature_payload_json"))


def fold_spans(spans: DataFrame, keys: Iterable[str], grid: Grid) -> DataFrame:
    """The payload of each key (without snapshot) at every snapshot: folded once per epoch, then spread."""
    keys = list(keys)
    return expand(fold_payload(common_epochs(spans, keys), [*keys, *SPAN]), grid)


def upsert_payload(payload: DataFrame, path: str, keys: Iterable[str], partition: str = "snapshot_date") -> None:
    """Keyed upsert of folded payloads into a table partitioned by snapshot day; a later run of a key replaces it."""
    rows = payload.withColumns({partition: F.to_date("snapshot_time"), "_at": F.lit(0)})
    upsert_path(payload.sparkSession, path, rows, [partition, *keys], ["_at"], partition)
