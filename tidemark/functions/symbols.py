"""Option and filing identifiers, event ids and headlines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import fmt_general

# Wording of triggered option indicators.
TRIGGER_PHRASES = {
    "trade_at_ask": "ask-side activity",
    "opening_activity": "opening activity",
    "iv_high_cross_section": "elevated IV",
}


def right_normalize(value: Column, strict: bool = True) -> Column:
    upper = F.upper(F.trim(value))
    known = F.when(upper.isin("C", "CALL"), F.lit("CALL")).when(upper.isin("P", "PUT"), F.lit("PUT"))
    if not strict:
        return known
    return known.otherwise(F.raise_error(F.lit("right must be CALL or PUT")).cast("string"))


def right_sort(value: Column) -> Column:
    upper = F.upper(value)
    return F.when(upper == "CALL", 0).when(upper == "PUT", 1).otherwise(2)


def option_symbol(underlying: Column, expiration: Column, right: Column, strike: Column) -> Column:
    return F.concat_ws(
        "_", F.upper(underlying), expiration.cast("string"), F.upper(F.left(right, F.lit(1))), fmt_general(strike)
    )


def contract_symbol(underlying: Column, expiration: Column, strike: Column, right: Column) -> Column:
    suffix = F.when(right == "CALL", "C").otherwise("P")
    return F.concat(underlying, F.lit(" "), expiration.cast("string"), F.lit(" "), fmt_general(strike), suffix)


def cik_pad(value: Column, strict: bool = True) -> Column:
    text = F.trim(value.cast("string"))
    padded = F.when(F.length(text) < 10, F.lpad(text, 10, "0")).otherwise(text)
    ok = F.when(text.rlike("^[0-9]+$"), padded)
    if not strict:
        return ok
    return ok.otherwise(F.raise_error(F.lit("cik must contain digits only")).cast("string"))


def event_id_equity(symbol: Column, event_time: Column) -> Column:
    """``eq_abn_SYMBOL_yyyymmdd_HHMMSS...``: ISO text squeezed to 24 characters."""
    squeezed = F.replace(F.regexp_replace(event_time, r"[-:+]", ""), F.lit("T"), F.lit("_"))
    return F.concat(F.lit("eq_abn_"), symbol, F.lit("_"), F.left(squeezed, F.lit(24)))


def event_id_fallback(category: Column, event_time: Column, symbol: Column, reference: Column) -> Column:
    """Deterministic id for events that arrive without one."""
    base = F.concat_ws(
        "|",
        F.lower(F.trim(F.coalesce(category, F.lit("event")))),
        F.coalesce(event_time.cast("string"), F.lit("")),
        F.upper(F.trim(F.coalesce(symbol, F.lit("")))),
        F.trim(F.coalesce(reference, F.lit(""))),
    )
    return F.concat(F.lit("evt_"), F.md5(base))


def event_headline(contract: Column, triggered: Column) -> Column:
    pairs = [item for pair in TRIGGER_PHRASES.items() for item in pair]
    table = F.create_map(*[F.lit(item) for item in pairs])
    phrases = F.transform(triggered, lambda t: F.coalesce(F.try_element_at(table, t), t))
    return F.concat(contract, F.lit(" draws "), F.array_join(phrases, " with "))


def activity_summary(symbol: Column, triggered: Column, timeframe: Column) -> Column:
    grain = F.coalesce(F.nullif(timeframe, F.lit("")), F.lit("input"))
    return F.concat(symbol, F.lit(" triggered "), F.array_join(triggered, ", "), F.lit(" over "), grain, F.lit(" bars."))
