"""Null-safe arithmetic and number parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def finite(value: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def safe_float(text: Column) -> Column:
    """Text to double; blank, unparsable and non-finite text is null."""
    trimmed = F.trim(text.cast("string"))
    return finite(F.when(trimmed.rlike(DECIMAL_TEXT), trimmed.try_cast("double")))


def safe_float_commas(text: Column) -> Column:
    """Like :func:`safe_float`, but thousands separators are dropped first."""
    return safe_float(F.replace(text.cast("string"), F.lit(","), F.lit("")))


def clean_num(text: Column) -> Column:
    """Numeric text without ``$``, ``,`` and ``%`` (still text)."""
    return F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[$,%]", ""))


def clean_float(text: Column) -> Column:
    return safe_float(clean_num(text))


def safe_div(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def safe_log_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when((numerator > 0) & (denominator > 0), F.ln(F.try_divide(numerator, denominator)))


def sign3(value: Column) -> Column:
    """-1, 0, 1 or null."""
    return F.signum(value).cast("int")


def fmt6(value: Column) -> Column:
    """Six decimals with trailing zeros stripped; null renders as empty text."""
    return F.coalesce(fmt_general(value), F.lit(""))


def fmt_general(value: Column) -> Column:
    """Plain decimal text without a trailing ``.0`` (strike prices)."""
    return F.when(value.isNotNull(), F.regexp_replace(F.format_string("%.6f", value), r"\.?0+$", ""))


def round_places(value: Column, places: int) -> Column:
    return F.round(value, places)


def whole_number(value: Column) -> Column:
    """Truncate to a whole number; missing counts as zero."""
    return F.coalesce(value.cast("double").cast("bigint"), F.lit(0).cast("bigint"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))
