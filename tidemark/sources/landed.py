"""Readers for landed files: keyed tables, CSV, paged JSON, holdings and calendar documents."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import clean_num
from ..functions.text import CALENDAR_ALIASES, HOLDING_ALIASES, alias_of, clean_cell, header_key

BAR_COLUMNS = ("symbol", "timeframe", "timestamp", "bar_open", "bar_high", "bar_low", "bar_close", "bar_volume")


def scan_bars(bars: DataFrame, start: str | None = None, end: str | None = None, ts: str = "timestamp",
              columns: Sequence[str] = BAR_COLUMNS) -> DataFrame:
    """The bar columns in an inclusive time range; range and columns reach the file scan."""
    rows = bars.select(*columns)
    if start:
        rows = rows.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        rows = rows.where(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    return rows


def ordered(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Deterministic output order: one range shuffle, only where a reader needs it."""
    return df.orderBy(*columns)


def read_reference_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Reviewed CSV with header: every value trimmed text, missing is empty text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', enforceSchema=False)
    return raw.select(*[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in columns])


def universe_filter(universe: DataFrame, needed: Sequence[str] = ("symbol", "bar_grain"), universe_type: str | None = None) -> DataFrame:
    """Universe rows whose needed fields are filled, optionally of one type."""
    rows = universe
    for c in needed:
        rows = rows.where(F.trim(F.coalesce(F.col(c), F.lit(""))) != "")
    if universe_type:
        rows = rows.where(F.col("universe_type") == universe_type)
    return rows


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop early when a reviewed list turns out empty (reads one row)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def requested_symbols(requested: str | Iterable[str]) -> list[str]:
    items = requested.split(",") if isinstance(requested, str) else requested
    return sorted({str(s).strip().upper() for s in items if str(s).strip()})


def select_symbols(universe: DataFrame, requested: DataFrame | None, symbol: str = "symbol") -> DataFrame:
    """Universe symbols, upper and distinct, cut down to the requested ones.

    ``requested``: one column ``symbol``, each value a symbol or a comma list.
    """
    have = universe.select(F.upper(F.trim(symbol)).alias("symbol")).where(F.col("symbol") != "").distinct()
    if requested is None:
        return have
    asked = requested.select(F.explode(F.split("symbol", ",")).alias("s")).select(F.upper(F.trim("s")).alias("symbol"))
    return have.join(asked.where(F.col("symbol") != ""), "symbol", "left_semi")


def each_item(df: DataFrame, keep: Sequence[str | Column], items: Column, name: str) -> DataFrame:
    """``keep`` and a row for each element of an array that is costly to make; null and empty arrays have none.

    From a plain explode Spark infers a filter on the array's size and pushes it down to the scan, where the array is made
    again, once for each expression in it. Of an outer one it infers nothing; the position tells the empty ones.
    """
    return df.select(*keep, F.posexplode_outer(items).alias("_place", name)).where(F.col("_place").isNotNull()).drop("_place")


def page_union(pages: DataFrame, row_key: str, element: str, text: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of all landed JSON pages; ``element`` is the DDL of one array element."""
    parsed = F.from_json(F.col(text), f"struct<{row_key}: array<struct<{element}>>>")
    return each_item(pages, keep, parsed[row_key], "_r").select(*keep, "_r.*")


# --------------------------------------------------------------------------- documents


def table_rows(html: Column, row_tag: str = "tr", cell_tags: str = "t[dh]") -> Column:
    """HTML rows as an array of arrays of clean cell text; rows without cells drop."""
    rows = F.regexp_extract_all(html, F.lit(rf"(?is)<{row_tag}\b[^>]*>(.*?)</{row_tag}>"), F.lit(1))
    cells = F.transform(
        rows,
        lambda r: F.transform(F.regexp_extract_all(r, F.lit(rf"(?is)<{cell_tags}\b[^>]*>(.*?)</{cell_tags}>"), F.lit(1)), clean_cell),
    )
    return F.filter(cells, lambda r: F.size(r) > 0)


def _first_match(rows: Column, test) -> Column:
    """1-based position of the first row that passes ``test``; 0 when none does."""
    return F.array_position(F.transform(rows, test), F.lit(True)).cast("int")


def _places(names: Column, wanted: Iterable[str]) -> Column:
    """Position by wanted header name; the right-most header of a name wins. One loop, as generated code of a step a name is too long to compile."""
    keys = F.array(*[F.lit(n) for n in wanted])
    back = lambda n: F.array_position(F.reverse(names), n)
    return F.map_from_arrays(keys, F.transform(keys, lambda n: F.when(back(n) > 0, F.size(names) - back(n)).cast("int")))


def _pick(name: str) -> Column:
    """Cell under a header name; empty text if there is no such header or cell."""
    return F.coalesce(F.get("_cells", F.col("_at")[name]), F.lit(""))


def _header_and_body(rows: DataFrame, ids: Sequence[str], head: Column, name_of, width: int, wanted: Iterable[str]) -> DataFrame:
    """``_rows`` to (ids, _at, _cells): places of the wanted headers and one body row each.

    Documents without a header row have an empty body and no rows.
    """
    at = rows.withColumn("_head", head)
    names = F.transform(F.get("_rows", F.col("_head") - 1), name_of)
    body = F.filter(F.slice("_rows", F.col("_head") + 1, F.size("_rows")), lambda r: F.size(r) >= width)
    none = F.array().cast("array<array<string>>")
    found = at.select(*ids, names.alias("_names"), F.when(F.col("_head") > 0, body).otherwise(none).alias("_body"))
    placed = found.select(*ids, _places(F.col("_names"), wanted).alias("_at"), "_body")  # once a document, not once a row
    return each_item(placed, [*ids, "_at"], F.col("_body"), "_cells")


CALENDAR_FIELDS = tuple(dict.fromkeys(CALENDAR_ALIASES.values()))


def calendar_rows(pages: DataFrame, html: str = "html", country: str = "United States", importance: str = "3") -> DataFrame:
    """Calendar tables to event rows. Needs ``html`` and ``source_url`` columns."""
    rows = pages.select("source_url", table_rows(F.col(html)).alias("_rows"))
    head = _first_match(F.col("_rows"), lambda r: F.exists(r, lambda c: F.lower(c).isin("actual", "previous")))
    lookup = F.create_map(*[F.lit(x) for pair in CALENDAR_ALIASES.items() for x in pair])
    known = lambda c: F.coalesce(F.try_element_at(lookup, F.lower(F.trim(c))), F.lit(""))
    each = _header_and_body(rows, ["source_url"], head, known, 4, CALENDAR_FIELDS)
    pick = _pick

    def or_else(name: str, other: Column) -> Column:
        return F.coalesce(F.nullif(pick(name), F.lit("")), other)

    event = or_else("event", F.get("_cells", F.lit(2)))
    return each.select(
        or_else("event_time", F.get("_cells", F.lit(0))).alias("event_time"),
        or_else("country", F.lit(country)).alias("country"),
        event.alias("event"),
        *[pick(n).alias(n) for n in ("source_event_type", "reference", "actual", "previous", "consensus", "te_forecast", "revised")],
        or_else("importance", F.lit(importance)).alias("importance"),
        pick("symbol").alias("symbol"),
        "source_url",
    ).where((F.col("event") != "") & ~F.lower("event").isin("event", "calendar"))


HOLDING_ID = ("etf_symbol", "issuer_name", "source_url", "default_as_of")
HOLDING_TEXT = ("holding_symbol", "holding_name", "weight", "shares", "market_value", "cusip", "sedol", "asset_class", "sector_type")
NUMERIC_TEXT = ("weight", "shares", "market_value")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _finish(rows: DataFrame) -> DataFrame:
    """Holding rows from documents' cells and header places; rows without symbol and name drop."""
    out = [F.coalesce(F.nullif(strip(_pick("as_of_date")), F.lit("")), F.col("default_as_of")).alias("as_of_date")]
    out += [(clean_num(_pick(n)) if n in NUMERIC_TEXT else strip(_pick(n))).alias(n) for n in HOLDING_TEXT]
    found = rows.select("etf_symbol", "issuer_name", *out, "source_url")
    return found.where((F.col("holding_symbol") != "") | (F.col("holding_name") != ""))


HOLDING_FIELDS = ("as_of_date", *HOLDING_TEXT)


def _canonical(cells: Column) -> Column:
    return F.transform(cells, lambda c: alias_of(header_key(c), HOLDING_ALIASES))


# A field is quoted (quotes doubled, line breaks allowed, open to the end of the text if need be) or runs to
# the next comma. Loops are possessive, so a long cell costs no stack.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:{_QUOTED}(?:"[^,\n]*+)?+|[^,\n]*+)'
_LINE_END = "\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def csv_records(text: Column) -> Column:
    """Records of CSV text with ``\\n`` line ends; line breaks inside quotes stay; empty lines drop."""
    found = F.regexp_extract_all(text, F.lit(rf"({_FIELD}(?:,{_FIELD})*+)(?:\n|\z)"), F.lit(1))
    return F.filter(found, lambda r: r != "")


def csv_cells(record: Column) -> Column:
    """Fields of one CSV record, quotes resolved, any number of fields."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_FIELD})"), F.lit(1))

    def plain(c: Column) -> Column:
        inside = F.replace(F.regexp_extract(c, rf'^"((?:[^"]*+)(?:""[^"]*+)*+)', 1), F.lit('""'), F.lit('"'))
        return F.when(F.startswith(c, F.lit('"')), F.concat(inside, F.regexp_replace(c, rf'^{_QUOTED}"?+', ""))).otherwise(c)

    return F.transform(raw, plain)


def holdings_csv(files: DataFrame, text: str = "text") -> DataFrame:
    """Holdings CSV documents: preamble lines are skipped up to the header line."""
    lines = F.split(F.regexp_replace(F.col(text), _LINE_END, "\n"), "\n")
    rows = files.select(*HOLDING_ID, lines.alias("_lines"))

    def is_header(line: Column) -> Column:
        low = F.lower(line)
        return F.contains(low, F.lit("ticker")) & low.rlike("weight|market value|% of")

    head = F.greatest(_first_match(F.col("_lines"), is_header), F.lit(1))
    rows = rows.select(*HOLDING_ID, csv_records(F.array_join(F.slice("_lines", head, F.size("_lines")), "\n")).alias("_records"))
    rows = rows.select(*HOLDING_ID, _canonical(csv_cells(F.get("_records", F.lit(0)))).alias("_names"), F.slice("_records", 2, F.size("_records")).alias("_body"))
    each = each_item(rows, [*HOLDING_ID, _places(F.col("_names"), HOLDING_FIELDS).alias("_at")], F.col("_body"), "_record")
    return _finish(each.withColumn("_cells", csv_cells(F.col("_record"))))


def holdings_html(files: DataFrame, html: str = "text") -> DataFrame:
    """Holdings HTML documents: the header row names a ticker and a weight."""
    rows = files.select(*HOLDING_ID, table_rows(F.col(html)).alias("_rows"))

    def is_header(r: Column) -> Column:
        return F.exists(r, lambda c: F.lower(c).isin("ticker", "symbol")) & F.exists(r, lambda c: F.lower(c).rlike("weight|%"))

    head = _first_match(F.col("_rows"), is_header)
    return _finish(_header_and_body(rows, HOLDING_ID, head, lambda c: alias_of(header_key(c), HOLDING_ALIASES), 2, HOLDING_FIELDS))


JSON_KEYS = ("holdings", "data", "rows", "fundHoldings")


def json_objects(text: str | None) -> list[dict]:
    """Row objects of a JSON document: those of a list, or of the lists below the known keys at any depth."""
    try:
        todo = [json.loads(text or "")]
    except ValueError:
        return []
    found: list[dict] = []
    while todo:
        value = todo.pop()
        if isinstance(value, list):
            found += [v for v in value if isinstance(v, dict)]
        elif isinstance(value, dict):
            todo += [value[k] for k in reversed(JSON_KEYS) if k in value]
    return found


def holdings_json(files: DataFrame, text: str = "text") -> DataFrame:
    """Holdings JSON documents: row lists under the known keys, however deep.

    Values are taken as text, 0, false and null as empty. Elements that are no objects are passed over; a document
    that is no JSON has no rows. The descent has no SQL form, so it runs in Python on Arrow batches.
    """

    def of(batches):
        for batch in batches:
            rows = batch[text].map(lambda t: [(list(map(str, m)), [str(v or "") for v in m.values()]) for m in json_objects(t)])
            yield batch[list(HOLDING_ID)].assign(_names=rows.map(lambda r: [n for n, _ in r]), _body=rows.map(lambda r: [c for _, c in r]))

    ids = ", ".join(f"{c} string" for c in HOLDING_ID)
    found = files.select(*[F.col(c).cast("string").alias(c) for c in HOLDING_ID], text).mapInPandas(
        of, f"{ids}, _names array<array<string>>, _body array<array<string>>")
    each = each_item(found, HOLDING_ID, F.arrays_zip("_names", "_body"), "_r")
    return _finish(each.select(*HOLDING_ID, _places(_canonical(F.col("_r._names")), HOLDING_FIELDS).alias("_at"), F.col("_r._body").alias("_cells")))
