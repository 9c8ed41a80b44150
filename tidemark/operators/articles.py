"""Article scan, filters and normalization."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (
    LOCATION_PHRASES,
    MARKET_DOMAINS,
    MARKET_PHRASES,
    category_terms,
    contains_any,
    haystack,
    like_text,
    term_pattern,
    tone_first,
)
from ..functions.times import parse_compact_utc

# Columns searched per mode.
SEARCH_FIELDS = {
    "source_theme_tags_text": ("themes", "names", "organizations", "persons"),
    "url_only": ("url",),
    "all_text": ("url", "themes", "names", "organizations", "persons", "locations"),
}
IMPACT_SCOPE = "market;sector;industry;theme"


def topic_filter(df: DataFrame, fields: str = "source_theme_tags_text", terms: Iterable[str] | None = None,
                 categories: Iterable[str] | None = None) -> Column:
    """Does the searched text hold any of the terms? Columns the table lacks are skipped."""
    if fields not in SEARCH_FIELDS:
        raise ValueError(f"search fields must be one of {sorted(SEARCH_FIELDS)}")
    wanted = list(terms) if terms else (category_terms(categories) if categories else category_terms())
    hay = haystack(*[F.col(c) for c in SEARCH_FIELDS[fields] if c in df.columns])
    return hay.rlike(term_pattern(wanted))


def domain_filter(domains: Iterable[str], domain: Column, url: Column) -> Column:
    """Source name holds the domain's stem, or the URL holds the domain."""
    cleaned = [like_text(d).lstrip(".") for d in domains if d.strip()]
    if not cleaned:
        return F.lit(False)
    stems = contains_any(F.lower(F.coalesce(domain, F.lit(""))), [d.replace(".com", "") for d in cleaned])
    return stems | contains_any(F.lower(F.coalesce(url, F.lit(""))), cleaned)


def market_focus(df: DataFrame, focus: str = "us_market", domains: Iterable[str] = MARKET_DOMAINS) -> Column:
    """Location, market phrase or allow-listed domain; ``focus='none'`` keeps everything."""
    if focus not in ("us_market", "none"):
        raise ValueError("focus must be us_market or none")
    if focus == "none":
        return F.lit(True)

    def have(*names: str) -> list[Column]:
        return [F.col(c) for c in names if c in df.columns]

    where = contains_any(haystack(*have("locations")), LOCATION_PHRASES)
    what = contains_any(haystack(*have("themes", "names", "organizations", "url")), MARKET_PHRASES)
    return where | what | domain_filter(domains, F.col("source_domain"), F.col("url"))


def article_scan(df: DataFrame, start: str, end: str, max_rows: int | None = None, *, fields: str = "source_theme_tags_text",
                 terms: Iterable[str] | None = None, focus: str = "us_market", domain_contains: str | None = None,
                 partition: str = "partition_date", order: str = "article_time", tie: Iterable[str] = ()) -> DataFrame:
    """Matching articles of a partition range; with ``max_rows``, the newest so many."""
    if end < start:
        raise ValueError("end must be >= start")
    if max_rows is not None and max_rows < 1:
        raise ValueError("max_rows must be positive")
    hit = df.where(F.col(partition).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    hit = hit.where(topic_filter(df, fields, terms) & market_focus(df, focus))
    if domain_contains:
        hit = hit.where(F.contains(F.lower(F.coalesce("source_domain", F.lit(""))), F.lit(like_text(domain_contains))))
    return hit if max_rows is None else topk_recent(hit, order, max_rows, tie)


def topk_recent(df: DataFrame, order: str, n: int, tie: Iterable[str] = ()) -> DataFrame:
    """The newest ``n`` rows (each task keeps n, the driver merges them)."""
    return df.orderBy(F.col(order).desc(), *tie).limit(n)


def normalize_articles(df: DataFrame, impact_scope: str = IMPACT_SCOPE, source_type: str = "gkg_article") -> DataFrame:
    """Article rows; those without URL drop, a missing id falls back to the URL."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    url = F.trim(F.coalesce(F.nullif(text("url"), F.lit("")), text("event_link_url")))
    ident = F.trim(F.coalesce(F.nullif(text("article_id"), F.lit("")), url))
    rows = df.withColumns({"_url": url, "_id": ident}).where((F.col("_url") != "") & (F.col("_id") != ""))
    return rows.select(
        F.col("_id").alias("article_id"),
        parse_compact_utc(F.col("article_date")).alias("seen_at"),
        text("source_domain").alias("source_domain"),
        F.col("_url").alias("event_link_url"),
        *[F.lit("").alias(n) for n in ("language", "source_country", "title")],
        text("source_theme_tags").alias("source_theme_tags"),
        text("persons").alias("persons"),
        text("organizations").alias("organizations"),
        text("locations").alias("locations"),
        tone_first(F.col("tone")).alias("tone"),
        text("sharing_image").alias("sharing_image"),
        F.lit(impact_scope).alias("impact_scope"),
        F.lit(source_type).alias("source_type"),
    )
