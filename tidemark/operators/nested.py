"""Nested payloads to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.symbols import option_symbol

# Parallel arrays of a filing list and their output names.
FILING_ARRAYS = {
    "accessionNumber": "accession_number",
    "filingDate": "filing_date",
    "reportDate": "report_date",
    "form": "form",
    "primaryDocument": "primary_document",
    "primaryDocDescription": "primary_doc_description",
}

# Fields of one fact value and their output names.
FACT_FIELDS = {
    "fy": "fy", "fp": "fp", "form": "form", "filed": "filed", "frame": "frame", "end": "end",
    "val": "value", "accn": "accession_number",
}


def flatten_filings(df: DataFrame, recent: str = "filings.recent") -> DataFrame:
    """Parallel arrays to one row per accession; arrays shorter than the ids pad with null."""
    ids = F.col(f"{recent}.accessionNumber")
    n = F.size(ids)

    def part(name: str) -> Column:
        values = F.coalesce(F.col(f"{recent}.{name}"), F.array().cast("array<string>"))
        return F.slice(values, F.lit(1), F.greatest(n, F.lit(0))).alias(name)

    zipped = F.arrays_zip(*[part(src) for src in FILING_ARRAYS])
    rows = df.where(n > 0).select("cik", F.col("name").alias("company_name"), F.explode_outer(zipped).alias("_f"))
    return rows.select("cik", "company_name", *[F.col("_f")[src].alias(out) for src, out in FILING_ARRAYS.items()])


def _values(rows: DataFrame, ids: Sequence[str], unit: str | None) -> DataFrame:
    """Explode ``units`` (unit -> values) to one row per value."""
    units = rows.select(*ids, F.explode("units").alias("unit", "_values"))
    if unit:
        units = units.where(F.col("unit") == unit)
    each = units.select(*ids, "unit", F.explode("_values").alias("_v")).where(F.col("_v").isNotNull())
    return each.select(*ids, "unit", *[F.col("_v")[src].alias(out) for src, out in FACT_FIELDS.items()])


def flatten_facts(df: DataFrame, taxonomy: str | None = None, tag: str | None = None, unit: str | None = None) -> DataFrame:
    """``facts[taxonomy][tag].units[unit][]`` to one row per value, with optional filters."""
    by_tax = df.select("cik", F.col("entityName").alias("entity_name"), F.explode("facts").alias("taxonomy", "_tags"))
    if taxonomy:
        by_tax = by_tax.where(F.col("taxonomy") == taxonomy)
    by_tag = by_tax.select("cik", "entity_name", "taxonomy", F.explode("_tags").alias("tag", "_fact"))
    if tag:
        by_tag = by_tag.where(F.col("tag") == tag)
    rows = by_tag.select("cik", "entity_name", "taxonomy", "tag", F.col("_fact.label").alias("label"),
                         F.col("_fact.description").alias("description"), F.col("_fact.units").alias("units"))
    return _values(rows, ["cik", "entity_name", "taxonomy", "tag", "label", "description"], unit)


def flatten_concept(df: DataFrame, taxonomy: str, tag: str, unit: str | None = None) -> DataFrame:
    """One concept document per company; taxonomy and tag come from the request."""
    rows = df.select("cik", F.col("entityName").alias("entity_name"), F.lit(taxonomy).alias("taxonomy"),
                     F.lit(tag).alias("tag"), "label", "description", "units")
    return _values(rows, ["cik", "entity_name", "taxonomy", "tag", "label", "description"], unit)


def frame_rows(df: DataFrame, taxonomy: str, tag: str, unit: str, frame: str) -> DataFrame:
    """Cross-company frame: one row per company with the request's constants."""
    each = df.select(F.explode("data").alias("_d")).where(F.col("_d").isNotNull())
    return each.select(
        F.lit(taxonomy).alias("taxonomy"), F.lit(tag).alias("tag"), F.lit(unit).alias("unit"), F.lit(frame).alias("frame"),
        F.col("_d.cik").alias("cik"), F.col("_d.entityName").alias("entity_name"), F.col("_d.loc").alias("loc"),
        F.col("_d.end").alias("end"), F.col("_d.val").alias("value"), F.col("_d.accn").alias("accession_number"),
    )


# Columns of a flat option-chain row by the struct they come from.
CHAIN_FIELDS = {
    "quote": ("bid", "ask", "mid", "spread", "spread_pct", "bid_size", "ask_size", "bid_exchange", "ask_exchange",
              "bid_condition", "ask_condition"),
    "iv": ("implied_vol", "iv_error"),
    "greeks": ("delta", "theta", "vega", "rho", "epsilon", "lambda"),
    "underlying_context": ("underlying_price", "underlying_timestamp"),
    "derived": ("days_to_expiration",),
}
CONTRACT_FIELDS = ("expiration", "option_right_type", "strike", "quote", "iv", "greeks", "derived", "underlying_context")
WHOLE_FIELDS = ("bid_exchange", "ask_exchange", "bid_condition", "ask_condition", "days_to_expiration")


def flatten_chain(snapshots: DataFrame, snapshot_type: str = "entry") -> DataFrame:
    """``contracts`` array of a chain snapshot to one wide row per contract."""
    if snapshot_type not in ("entry", "exit"):
        raise ValueError("snapshot_type must be 'entry' or 'exit'")
    return _wide(snapshots.select("underlying", "snapshot_time", F.explode("contracts").alias("c")).where(F.col("c").isNotNull()), snapshot_type)


def flatten_contracts(contracts: DataFrame, underlying: Column, snapshot_time: Column, snapshot_type: str = "entry") -> DataFrame:
    """Contract rows (see ``joins.chain_rows``) to wide rows, without putting a chain together."""
    if snapshot_type not in ("entry", "exit"):
        raise ValueError("snapshot_type must be 'entry' or 'exit'")
    return _wide(contracts.select(underlying.alias("underlying"), snapshot_time.alias("snapshot_time"), F.struct(*CONTRACT_FIELDS).alias("c")), snapshot_type)


def _wide(each: DataFrame, snapshot_type: str) -> DataFrame:
    element = each.schema["c"].dataType

    def field(struct: str, name: str) -> Column:
        inner = element[struct].dataType.names if struct in element.names else []
        if name not in inner:
            return F.lit(None)
        return F.col(f"c.{struct}.{name}")

    def typed(struct: str, name: str) -> Column:
        value = field(struct, name)
        if name == "underlying_timestamp":
            return value
        value = value.cast("double")
        return value.cast("bigint") if name in WHOLE_FIELDS else value

    strike = F.col("c.strike").cast("double")
    return each.select(
        "underlying",
        "snapshot_time",
        F.lit(snapshot_type).alias("snapshot_type"),
        option_symbol(F.col("underlying"), F.col("c.expiration"), F.col("c.option_right_type"), strike).alias("option_symbol"),
        F.col("c.expiration").alias("expiration"),
        F.col("c.option_right_type").alias("option_right_type"),
        strike.alias("strike"),
        *[typed(s, n).alias(n) for s, names in CHAIN_FIELDS.items() for n in names],
    )


def chain_snapshot(contracts: DataFrame, underlying: Column, snapshot_time: Column, order: Sequence[str]) -> DataFrame:
    """Contract rows to nested snapshot rows, one for each underlying and expiration (the snapshot's file form).

    The strikes that an exchange lists for one expiration bound a row.
    """
    keyed = contracts.select(underlying.alias("underlying"), snapshot_time.alias("snapshot_time"), "expiration",
                             F.struct(*order, F.struct(*CONTRACT_FIELDS).alias("_c")).alias("_k"))
    return keyed.groupBy("underlying", "snapshot_time", "expiration").agg(
        F.count(F.lit(1)).alias("contract_count"),
        F.transform(F.sort_array(F.collect_list("_k")), lambda k: k["_c"]).alias("contracts"),
    )


def normalize_candles(df: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Positional candles (time ms, o, h, l, c, volume, ... at least 9 fields) to bar rows."""
    from ..functions.times import epoch_ms_to_et

    candle = F.col("candle")
    if strict:
        candle = F.when(F.size(candle) >= 9, candle).otherwise(
            F.raise_error(F.lit("candle row must have at least 9 fields")).cast("array<string>")
        )

    def number(i: int) -> Column:
        return F.element_at(candle, i).cast("double")

    return df.select(
        *keep,
        "symbol",
        "timeframe",
        epoch_ms_to_et(F.element_at(candle, 1)).alias("ts"),
        number(2).alias("bar_open"),
        number(3).alias("bar_high"),
        number(4).alias("bar_low"),
        number(5).alias("bar_close"),
        number(6).alias("bar_volume"),
        F.lit(None).cast("double").alias("bar_vwap"),
        F.lit(None).cast("bigint").alias("bar_trade_count"),
    )


def normalize_crypto_trades(df: DataFrame) -> DataFrame:
    """Text trades (ts ms, px, sz) to typed rows with notional."""
    from ..functions.times import epoch_ms_to_et

    px, sz = F.col("px").cast("double"), F.col("sz").cast("double")
    utc = F.timestamp_add("MILLISECOND", F.col("ts").cast("bigint"), F.lit("1970-01-01").cast("timestamp_ntz"))
    return df.select(
        F.upper("instId").alias("symbol"),
        utc.alias("timestamp_utc"),
        epoch_ms_to_et(F.col("ts")).alias("ts"),
        F.coalesce(F.col("tradeId").cast("string"), F.lit("")).alias("trade_id"),
        F.coalesce("side", F.lit("")).alias("side"),
        px.alias("price"),
        sz.alias("size"),
        F.round(px * sz, 12).alias("notional"),
    )


def normalize_equity_bars(df: DataFrame) -> DataFrame:
    """Provider bars ``{t,o,h,l,c,v,vw,n}`` with symbol and timeframe to bar rows."""
    from ..functions.times import normalize_timeframe, parse_ts_et

    return df.select(
        F.upper("symbol").alias("symbol"),
        normalize_timeframe(F.col("timeframe")).alias("timeframe"),
        parse_ts_et(F.col("t")).alias("ts"),
        F.col("o").cast("double").alias("bar_open"),
        F.col("h").cast("double").alias("bar_high"),
        F.col("l").cast("double").alias("bar_low"),
        F.col("c").cast("double").alias("bar_close"),
        F.col("v").cast("double").alias("bar_volume"),
        F.col("vw").cast("double").alias("bar_vwap"),
        F.col("n").cast("bigint").alias("bar_trade_count"),
    )


def normalize_news(df: DataFrame) -> DataFrame:
    """Provider news to timeline rows; missing symbols become an empty array."""
    from ..functions.times import parse_ts_et

    return df.select(
        "id",
        F.col("headline").alias("timeline_headline"),
        parse_ts_et(F.col("created_at")).alias("created_at"),
        parse_ts_et(F.col("updated_at")).alias("updated_at"),
        F.coalesce("symbols", F.array().cast("array<string>")).alias("symbols"),
        "summary",
        F.col("url").alias("event_link_url"),
    )


def option_rows(files: DataFrame, element: str, body: str = "body", order: str = "seq", first_only: bool = False) -> DataFrame:
    """Provider option files ``{"response": [{"contract": {...}, "data": [...]}]}`` to contract rows.

    ``element`` is the DDL of one data element, ``order`` a column that orders the files. Gives symbol, expiration, strike,
    option_right_type (as :func:`chain_rows`, :func:`option_bars` and :func:`window_stats` take them), the element's
    columns, ``arrival`` (file, contract, element) and ``has_data``. Contracts with an empty key field drop. With
    ``first_only`` (snapshots) a contract gives one row from its first element, or a row without data.
    """
    contract = "struct<symbol: string, expiration: string, right: string, strike: string>"
    parsed = F.from_json(F.col(body), f"struct<response: array<struct<contract: {contract}, data: array<struct<{element}>>>>>")
    # an outer explode, so that Spark infers no filter that parses the file again
    each = files.select(F.col(order).alias("_file"), F.posexplode_outer(parsed["response"]).alias("_at", "_r")).where(F.col("_at").isNotNull())
    key = {
        "symbol": F.upper("_r.contract.symbol"),
        "expiration": F.col("_r.contract.expiration"),
        "strike": F.col("_r.contract.strike").try_cast("double"),
        "option_right_type": F.upper("_r.contract.right"),
    }
    each = each.withColumns(key)
    for name in key:
        each = each.where(F.col(name).isNotNull() & (F.col(name).cast("string") != ""))
    keys = list(key)
    if first_only:
        rows = each.select(*keys, F.struct("_file", "_at", F.lit(0).alias("_n")).alias("arrival"), F.get("_r.data", F.lit(0)).alias("_d"))
    else:
        rows = each.select(*keys, "_file", "_at", F.posexplode("_r.data").alias("_n", "_d"))
        rows = rows.select(*keys, F.struct("_file", "_at", "_n").alias("arrival"), "_d")
    return rows.select(*keys, "arrival", F.col("_d").isNotNull().alias("has_data"), "_d.*")
