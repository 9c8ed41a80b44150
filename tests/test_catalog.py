"""The registered queries: contract, and a sample of them against DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from tidemark.catalog import load

SMALL = "/root/testdata/sf0.001"
SAMPLE = ("trade_bars", "quote_bars", "foj_bar_liquidity", "option_bars", "asof_latest_close", "ewma_vol", "trailing_zscore",
          "equity_abnormal_events", "option_activity_events", "facts_explode", "holdings_clean", "upsert_keyed", "parse_ts_et", "redact_url_query")
SAMPLE += ("event_id_fallback", "source_market_bars", "holdings_csv_ingest", "holdings_json_ingest", "calendar_parse", "foj_chain_3way")
KEYS = tuple(load()[0]) if os.environ.get("FULL_ORACLE") else SAMPLE


def test_every_query_has_sql_and_is_registered():
    own, sql = load()
    assert set(own) == set(sql) and set(own) <= set(entry.queries()) and set(sql) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables absent")
@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, key):
    status, note, _ = compare(spark, duck(SMALL), key, entry.queries()[key], entry.oracle_sql().get(key), SMALL)
    spark.catalog.clearCache()
    assert status in ("ok", "rows"), note
