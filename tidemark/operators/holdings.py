"""Fund holdings: normalization, filters, accounting, exposure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import clean_float, clean_num
from ..functions.text import HOLDING_ALIASES, header_key_text, is_us_equity

HOLDING_FIELDS = (
    "etf_symbol", "issuer_name", "as_of_date", "holding_symbol", "holding_name", "weight", "shares", "market_value",
    "cusip", "sedol", "asset_class", "sector_type", "source_url",
)


def canonical_columns(df: DataFrame) -> DataFrame:
    """Snake-case headers and rename known aliases.

    When several source columns map to one name the right-most wins, as in a keyed row.
    """
    targets: dict[str, str] = {}
    for name in df.columns:
        key = header_key_text(name)
        targets[HOLDING_ALIASES.get(key, key)] = name
    return df.select(*[F.col(f"`{src}`").alias(out) for out, src in targets.items()])


def normalize_holdings(df: DataFrame) -> DataFrame:
    """Holdings rows as cleaned text; needs etf_symbol, issuer_name, source_url, default_as_of on each row."""

    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))) if name in df.columns else F.lit("")

    out = df.select(
        F.col("etf_symbol"),
        F.col("issuer_name"),
        F.coalesce(F.nullif(text("as_of_date"), F.lit("")), text("default_as_of")).alias("as_of_date"),
        text("holding_symbol").alias("holding_symbol"),
        text("holding_name").alias("holding_name"),
        clean_num(text("weight")).alias("weight"),
        clean_num(text("shares")).alias("shares"),
        clean_num(text("market_value")).alias("market_value"),
        *[text(n).alias(n) for n in ("cusip", "sedol", "asset_class", "sector_type", "source_url")],
    )
    return out.where((F.col("holding_symbol") != "") | (F.col("holding_name") != ""))


def holding_reason(start: str, end: str) -> Column:
    """Why a raw holding is rejected, first match wins; null keeps it."""
    symbol = F.trim(F.coalesce(F.col("holding_symbol"), F.lit("")))
    day = F.left(F.coalesce(F.col("as_of_date"), F.lit("")), F.lit(10))
    outside = (day != "") & ((day < start[:10]) | (day > end[:10]))
    us = is_us_equity(F.col("holding_symbol"), F.col("holding_name"), F.col("asset_class"))
    return (
        F.when(symbol == "", F.lit("missing_symbol"))
        .when(outside, F.lit("outside_window"))
        .when(~us, F.lit("non_us_or_non_equity"))
    )


def holdings_clean(raw: DataFrame, universe: DataFrame, start: str, end: str, available: str | None = None, order: str | None = None) -> DataFrame:
    """Kept holdings with universe labels, parsed numbers and a default available time.

    Of several universe rows of a symbol the last by ``order`` counts, whole.

    The default uses a fixed -04:00 offset all year (kept for equal results).
    """
    kept = raw.where(holding_reason(start, end).isNull())
    labels = universe.groupBy(F.upper(F.trim("symbol")).alias("etf_symbol")).agg(
        F.max_by(F.struct("issuer_name", "universe_type", "exposure_type"), F.struct(*[F.col(c) for c in ([order] if order else ["issuer_name", "universe_type", "exposure_type"])])).alias("u")
    )
    day = F.left(F.coalesce(F.col("as_of_date"), F.lit("")), F.lit(10))
    seen = F.when(day != "", F.concat(day, F.lit("T09:30:00-04:00"))).otherwise(F.lit(""))
    own = F.nullif(F.trim(F.col("available_time").cast("string")), F.lit("")) if "available_time" in raw.columns else F.lit(None)
    rows = kept.withColumn("etf_symbol", F.upper("etf_symbol")).join(labels, "etf_symbol", "left")
    blank = F.lit("")
    return rows.select(
        "etf_symbol",
        F.coalesce(F.nullif(F.col("u.issuer_name"), blank), F.col("issuer_name"), blank).alias("issuer_name"),
        F.coalesce(F.col("u.universe_type"), blank).alias("universe_type"),
        F.coalesce(F.col("u.exposure_type"), blank).alias("exposure_type"),
        day.alias("as_of_date"),
        F.coalesce(F.lit(available), own, seen).alias("available_time"),
        F.upper(F.trim("holding_symbol")).alias("holding_symbol"),
        F.coalesce("holding_name", blank).alias("holding_name"),
        clean_float(F.col("weight")).alias("weight"),
        clean_float(F.col("shares")).alias("shares"),
        clean_float(F.col("market_value")).alias("market_value"),
        F.coalesce("sector_type", blank).alias("sector_type"),
    )


def fund_exposure_by_stock(holdings: DataFrame, scores: DataFrame) -> DataFrame:
    """Per stock and day: funds holding it, top fund, weighted scores, tags and count.

    ``scores``: etf_symbol, sector_score, theme_score, tag. The number of funds per stock is
    bounded by the reviewed fund list.
    """
    rows = holdings.join(scores, "etf_symbol", "left")
    w = F.coalesce(F.col("weight"), F.lit(0.0))
    return rows.groupBy(F.col("holding_symbol").alias("symbol"), "as_of_date").agg(
        F.array_join(F.sort_array(F.collect_set("etf_symbol")), ";").alias("exposed_etfs"),
        F.max_by("etf_symbol", F.struct(w.alias("w"), F.col("etf_symbol"))).alias("top_exposure_etf"),
        F.sum(w).alias("total_etf_exposure_score"),
        F.sum(w * F.col("sector_score")).alias("weighted_sector_score"),
        F.sum(w * F.col("theme_score")).alias("weighted_theme_score"),
        F.array_join(F.sort_array(F.collect_set("tag")), ";").alias("exposure_tags"),
        F.count_distinct("etf_symbol").alias("source_etf_count"),
        F.max("available_time").alias("available_time"),
    )
