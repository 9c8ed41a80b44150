"""Text patterns for articles, holdings and landed HTML."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column, functions as F

# Topic categories and their terms.
TOPIC_TERMS = {
    "politics": ("government", "congress", "white house", "election", "regulation", "policy", "tariff", "sanction", "supreme court", "federal reserve"),
    "economy": ("inflation", "cpi", "ppi", "jobs", "payrolls", "unemployment", "gdp", "recession", "consumer spending", "retail sales", "interest rates", "treasury yields"),
    "war": ("war", "military", "missile", "conflict", "invasion", "geopolitical", "defense", "terrorism", "ceasefire", "shipping route"),
    "technology": ("technology", "semiconductor", "chip", "artificial intelligence", "ai", "cybersecurity", "cloud", "export controls", "data center", "software"),
}

# Domains that count as US market coverage.
MARKET_DOMAINS = (
    "apnews.com", "barrons.com", "bloomberg.com", "cnbc.com", "cnn.com", "finance.yahoo.com", "forbes.com",
    "fortune.com", "foxbusiness.com", "marketwatch.com", "nytimes.com", "politico.com", "reuters.com",
    "techcrunch.com", "thehill.com", "theverge.com", "washingtonpost.com", "wired.com", "wsj.com",
)

# Location and market phrases of the US market focus.
LOCATION_PHRASES = ("united states", "#us#")
MARKET_PHRASES = ("federal reserve", "wall street", "nasdaq", "s&p 500", "dow jones", "u.s. stock")

# Holding filters.
TICKER_SHAPE = r"^[A-Z][A-Z0-9.\-]{0,9}$"
EXCLUDED_ASSET_WORDS = r"\b(cash|money market|treasury|bond|fixed income|future|futures|swap|option|warrant|fund|etf|preferred)\b"
NON_US_WORDS = r"\b(adr|gdr|foreign|depositary|ltd|plc|s\.a\.|ag|nv|oyj|asa|spa|se|kk|co ltd|limited)\b"
EQUITY_CLASS_WORDS = r"equity|stock|common"

# Header aliases of holdings files. Keys are compared after header_key, so percent headers become of_net_assets and of_fund.
HOLDING_ALIASES = {
    "ticker": "holding_symbol",
    "symbol": "holding_symbol",
    "name": "holding_name",
    "holding": "holding_name",
    "holdings": "holding_name",
    "company": "holding_name",
    "security_name": "holding_name",
    "weight_percent": "weight",
    "of_net_assets": "weight",
    "of_fund": "weight",
    "shares_held": "shares",
    "sector": "sector_type",
    "date": "as_of_date",
}

# Header aliases of calendar tables.
CALENDAR_ALIASES = {
    "date": "event_time",
    "time": "event_time",
    "country": "country",
    "event": "event",
    "calendar": "event",
    "category": "source_event_type",
    "source_event_type": "source_event_type",
    "reference": "reference",
    "actual": "actual",
    "previous": "previous",
    "consensus": "consensus",
    "forecast": "te_forecast",
    "te forecast": "te_forecast",
    "revised": "revised",
    "importance": "importance",
    "symbol": "symbol",
}

def like_text(term: str) -> str:
    """A term as it is searched: lower case, without wildcard, backslash and quote."""
    return re.sub(r"[%\\']", "", term.lower())


def term_pattern(terms: Iterable[str]) -> str:
    """One alternation of literal terms, for a lower-cased haystack."""
    escaped = [re.escape(like_text(t)) for t in terms if like_text(t)]
    if not escaped:
        raise ValueError("terms resolved to an empty pattern")
    return "(" + "|".join(escaped) + ")"


def category_terms(categories: Iterable[str] = tuple(TOPIC_TERMS)) -> list[str]:
    wanted = [c.strip().lower() for c in categories]
    unknown = sorted(set(wanted) - set(TOPIC_TERMS))
    if unknown:
        raise ValueError(f"unsupported topic categories: {unknown}")
    return sorted({term for c in wanted for term in TOPIC_TERMS[c]})


def haystack(*columns: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns]))


def contains_any(hay: Column, phrases: Iterable[str]) -> Column:
    """One literal alternation per row instead of one scan per phrase."""
    return hay.rlike("|".join(re.escape(p) for p in phrases))


def header_key(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def header_key_text(text: str) -> str:
    return re.sub("[^a-z0-9]+", "_", text.lower()).strip("_")


def alias_of(key: Column, table: dict[str, str]) -> Column:
    """Mapped name, or the key itself when it has no alias."""
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, key), key)


# A character reference as HTML reads it, with or without its semicolon.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that count without a semicolon, longest first.
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _named() -> Column:
    """Characters of all named references, by the first two letters of the name and the name."""
    table: dict[str, dict[str, str]] = {}
    for name, chars in html5.items():
        table.setdefault(name[:2], {})[name] = chars
    return F.from_json(F.lit(json.dumps(table)), "map<string, map<string, string>>")


def _codepoint(code: Column) -> Column:
    """The character of a number: Windows-1252 for 128 to 159, a replacement where there is none, nothing for controls."""
    windows = F.array(*[F.lit(bytes([c]).decode("cp1252", "ignore") or chr(c)) for c in range(0x80, 0xA0)])
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    control = code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code % 65536 >= 0xFFFE)
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
        .when(code.between(0x80, 0x9F), F.get(windows, (code - 0x80).cast("int")))
        .when(control, "").otherwise(char)
    )


def _resolved(ref: Column) -> Column:
    """What a reference (without its ``&``) stands for."""
    digits, hexa = F.regexp_extract(ref, "^#([0-9]+)", 1), F.regexp_extract(ref, "^#[xX]([0-9a-fA-F]+)", 1)
    # longer numbers lie beyond Unicode
    code = F.when(hexa != "", F.conv(F.right(hexa, F.lit(9)), 16, 10)).otherwise(F.right(digits, F.lit(15))).try_cast("bigint")
    code = F.when(F.char_length(F.regexp_replace(F.concat(digits, hexa), "^0+", "")) > 9, F.lit(1 << 40)).otherwise(code)
    named = F.try_element_at(F.try_element_at(_named(), F.left(ref, F.lit(2))), ref)
    bare = F.regexp_extract(ref, "^(" + "|".join(BARE_NAMES) + ")", 1)
    short = F.concat(F.try_element_at(F.try_element_at(_named(), F.left(bare, F.lit(2))), bare), F.substring(ref, F.char_length(bare) + 1, F.lit(64)))
    common = F.when(ref == "amp;", "&").when(ref == "lt;", "<").when(ref == "gt;", ">").when(ref == "quot;", '"').when(ref == "nbsp;", "\u00a0")
    return common.when(F.startswith(ref, F.lit("#")), _codepoint(code)).otherwise(
        F.coalesce(named, F.when(bare != "", short), F.concat(F.lit("&"), ref)))


def unescape(text: Column) -> Column:
    """Decode all HTML character references, numeric and named; nothing is decoded twice."""
    plain = F.split(text, REFERENCE, -1)
    refs = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), _resolved)
    pieces = F.zip_with(plain, refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def clean_cell(html: Column) -> Column:
    """Cell text: tags dropped, entities decoded, white space squeezed."""
    bare = unescape(F.regexp_replace(html, "<[^>]+>", " "))
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def tone_first(tone: Column) -> Column:
    return F.coalesce(F.substring_index(tone, ",", 1), F.lit(""))


def is_us_equity(symbol: Column, name: Column, asset_class: Column) -> Column:
    """Keep rows that look like US-listed common stock."""
    ticker = F.upper(F.trim(F.coalesce(symbol, F.lit(""))))
    label = F.coalesce(name, F.lit(""))
    kind = F.coalesce(asset_class, F.lit(""))
    return (
        ticker.rlike(TICKER_SHAPE)
        & ~F.concat_ws(" ", kind, label).rlike("(?i)" + EXCLUDED_ASSET_WORDS)
        & ~label.rlike("(?i)" + NON_US_WORDS)
        & ((kind == "") | kind.rlike("(?i)" + EQUITY_CLASS_WORDS))
    )
