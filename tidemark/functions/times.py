"""New York wall-clock time helpers.

Inside the library every timestamp is a zone-less ``TIMESTAMP_NTZ`` holding the New
York wall clock, so buckets and comparisons never depend on the session time zone.
Instants are converted at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ET = "America/New_York"

# Supported bar widths in seconds.
WIDTHS = {
    "1Sec": 1,
    "1Min": 60,
    "5Min": 300,
    "15Min": 900,
    "30Min": 1800,
    "1Hour": 3600,
    "1Day": 86400,
}

# Accepted spellings of bar widths.
TIMEFRAME_ALIASES = {
    "1d": "1Day",
    "1day": "1Day",
    "day": "1Day",
    "daily": "1Day",
    "30m": "30Min",
    "30min": "30Min",
    "30minute": "30Min",
    "1m": "1Min",
    "1min": "1Min",
    "1minute": "1Min",
}

# Spellings that mean a daily bar.
DAILY_NAMES = ("1d", "1day", "day", "daily")

OFFSET_TEXT = r"[T ][0-9].*(Z|[+-][0-9]{2}:?[0-9]{2})$"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def instant_to_et(instant: Column) -> Column:
    """TIMESTAMP (an instant) to the New York wall clock."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())
    return F.convert_timezone(F.lit("UTC"), F.lit(ET), utc)


def wall_to_et(wall: Column, zone: str) -> Column:
    """Wall clock of another zone to the New York wall clock."""
    return F.convert_timezone(F.lit(zone), F.lit(ET), wall)


def epoch_ms_to_et(ms: Column) -> Column:
    utc = F.timestamp_add("MILLISECOND", ms.try_cast("bigint"), _epoch())
    return F.convert_timezone(F.lit("UTC"), F.lit(ET), utc)


def parse_ts_et(text: Column, naive_zone: str = ET) -> Column:
    """ISO text to New York wall clock; text without offset is read in ``naive_zone``.

    Unparsable text gives null.
    """
    trimmed = F.trim(text)
    naive = trimmed.try_cast("timestamp_ntz")
    if naive_zone != ET:
        naive = wall_to_et(naive, naive_zone)
    return F.when(trimmed.rlike(OFFSET_TEXT), instant_to_et(F.try_to_timestamp(trimmed))).otherwise(naive)


def parse_compact_utc(text: Column) -> Column:
    """``YYYYMMDDHHMMSS`` or ``YYYYMMDD`` in UTC to New York wall clock, else null."""
    digits = text.cast("string")
    padded = F.when(digits.rlike("^[0-9]{14}$"), digits).when(
        digits.rlike("^[0-9]{8}$"), F.concat(digits, F.lit("000000"))
    )
    iso = F.regexp_replace(
        padded, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"
    )
    return wall_to_et(iso.try_cast("timestamp_ntz"), "UTC")


def iso_et(wall: Column, always_fraction: bool = False) -> Column:
    """Render the wall clock as ISO text with its New York offset (sinks only).

    A whole second has no fraction, unless ``always_fraction`` asks for six digits everywhere.
    """
    text = F.replace(wall.cast("string"), F.lit(" "), F.lit("T"))
    whole = F.substring_index(text, ".", 1)
    fraction = F.when(
        F.contains(text, F.lit(".")),
        F.concat(F.lit("."), F.rpad(F.substring_index(text, ".", -1), 6, "0")),
    ).otherwise(F.lit(".000000" if always_fraction else ""))
    utc = F.convert_timezone(F.lit(ET), F.lit("UTC"), wall)
    hours = F.timestamp_diff("HOUR", wall, utc)
    return F.concat(whole, fraction, F.format_string("-%02d:00", hours))


def day_start(wall: Column) -> Column:
    return F.to_date(wall).cast("timestamp_ntz")


def second_of_day(wall: Column) -> Column:
    return F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def bucket_start(wall: Column, width: str) -> Column:
    """Floor of the wall clock since midnight to a bar width (scalar form)."""
    if width == "1Day":
        return day_start(wall)
    sod = second_of_day(wall)
    return F.timestamp_add("SECOND", sod - F.pmod(sod, F.lit(WIDTHS[width])), day_start(wall))


def tumbling(df: DataFrame, ts: str, width: str, name: str = "bucket") -> DataFrame:
    """Add the tumbling bucket start; all widths divide a day, so epoch buckets align."""
    if width not in WIDTHS:
        raise ValueError(f"unsupported timeframe {width!r}; supported={sorted(WIDTHS)}")
    if width == "1Day":
        return df.where(F.col(ts).isNotNull()).withColumn(name, day_start(F.col(ts)))
    return df.withColumn(name, F.window(F.col(ts), f"{WIDTHS[width]} seconds")["start"])


def ms_of_day(wall: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", day_start(wall), wall)


def days_to_expiration(expiration: Column, snapshot: Column) -> Column:
    return F.datediff(expiration.try_cast("date"), F.to_date(snapshot)).cast("bigint")


def is_daily(timeframe: Column) -> Column:
    return F.lower(F.trim(F.coalesce(timeframe, F.lit("")))).isin(*DAILY_NAMES)


def normalize_timeframe(timeframe: Column) -> Column:
    trimmed = F.trim(timeframe)
    pairs = [item for pair in TIMEFRAME_ALIASES.items() for item in pair]
    table = F.create_map(*[F.lit(item) for item in pairs])
    return F.coalesce(F.try_element_at(table, F.lower(trimmed)), trimmed)


def available_time(ts: Column, timeframe: Column, availability: str = "start", width_s: Column | None = None) -> Column:
    """When a bar becomes visible: 16:00 of its day for daily bars, else its own time.

    ``availability='end'`` makes an intraday bar visible only once it has closed.
    """
    intraday = ts
    if availability == "end":
        if width_s is None:
            raise ValueError("availability='end' needs the bar width in seconds")
        intraday = F.timestamp_add("SECOND", width_s, ts)
    return F.when(is_daily(timeframe), F.timestamp_add("HOUR", F.lit(16), day_start(ts))).otherwise(intraday)
