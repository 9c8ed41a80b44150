"""Durable table contracts: column types, NOT NULL columns and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    ddl: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        """Parsed on use: reading DDL needs a running session."""
        return T.StructType.fromDDL(self.ddl)


def _table(ddl: str, key: str) -> Table:
    return Table(ddl, tuple(key.split()))


BAR_FIELDS = (
    "bar_open DOUBLE, bar_high DOUBLE, bar_low DOUBLE, bar_close DOUBLE, bar_volume DOUBLE, "
    "bar_vwap DOUBLE, bar_trade_count BIGINT"
)

# The durable contracts. Times are New York wall clocks.
TABLES = {
    "market_bars": _table(
        f"symbol STRING NOT NULL, timeframe STRING NOT NULL, timestamp TIMESTAMP_NTZ NOT NULL, {BAR_FIELDS}",
        "symbol timeframe timestamp",
    ),
    "artifact_reference": _table(
        "run_id STRING NOT NULL, task_id STRING NOT NULL, source STRING NOT NULL, model_id STRING NOT NULL, "
        "as_of TIMESTAMP_NTZ NOT NULL, input_role STRING NOT NULL, data_kind STRING NOT NULL, "
        "artifact_reference STRING NOT NULL, required BOOLEAN NOT NULL, point_in_time BOOLEAN NOT NULL, notes STRING, "
        "created_at TIMESTAMP_NTZ NOT NULL",
        "run_id source input_role data_kind artifact_reference",
    ),
    "fund_holdings": _table(
        "etf_symbol STRING NOT NULL, issuer_name STRING NOT NULL, universe_type STRING NOT NULL, exposure_type STRING NOT NULL, "
        "as_of_date DATE NOT NULL, available_time TIMESTAMP_NTZ NOT NULL, holding_symbol STRING NOT NULL, holding_name STRING, "
        "weight DOUBLE, shares DOUBLE, market_value DOUBLE, sector_type STRING",
        "etf_symbol as_of_date holding_symbol",
    ),
    "strategy_bars": _table(
        f"symbol STRING NOT NULL, timeframe STRING NOT NULL, timestamp TIMESTAMP_NTZ NOT NULL, {BAR_FIELDS}, "
        "dollar_volume DOUBLE, quote_count BIGINT, avg_bid DOUBLE, avg_ask DOUBLE, avg_bid_size DOUBLE, avg_ask_size DOUBLE, "
        "avg_spread DOUBLE, spread_bps DOUBLE, last_bid DOUBLE, last_ask DOUBLE",
        "symbol timeframe timestamp",
    ),
    "option_chain": _table(
        "underlying STRING NOT NULL, snapshot_time TIMESTAMP_NTZ NOT NULL, snapshot_type STRING NOT NULL, "
        "option_symbol STRING NOT NULL, expiration DATE NOT NULL, option_right_type STRING NOT NULL, strike DOUBLE NOT NULL, "
        "bid DOUBLE, ask DOUBLE, mid DOUBLE, spread DOUBLE, spread_pct DOUBLE, bid_size DOUBLE, ask_size DOUBLE, "
        "bid_exchange BIGINT, ask_exchange BIGINT, bid_condition BIGINT, ask_condition BIGINT, implied_vol DOUBLE, "
        "iv_error DOUBLE, delta DOUBLE, theta DOUBLE, vega DOUBLE, rho DOUBLE, epsilon DOUBLE, lambda DOUBLE, "
        "underlying_price DOUBLE, underlying_timestamp TIMESTAMP_NTZ, days_to_expiration BIGINT",
        "underlying snapshot_time snapshot_type option_symbol",
    ),
    "position_bars": _table(
        "underlying STRING NOT NULL, option_symbol STRING NOT NULL, expiration DATE NOT NULL, option_right_type STRING NOT NULL, "
        "strike DOUBLE NOT NULL, timeframe STRING NOT NULL, timestamp TIMESTAMP_NTZ NOT NULL, bar_open DOUBLE, bar_high DOUBLE, "
        "bar_low DOUBLE, bar_close DOUBLE, bar_volume DOUBLE, bar_trade_count BIGINT, bar_vwap DOUBLE",
        "option_symbol timeframe timestamp",
    ),
    "event_overview": _table(
        "event_id STRING NOT NULL, event_time TIMESTAMP_NTZ NOT NULL, available_time TIMESTAMP_NTZ NOT NULL, "
        "information_role_type STRING NOT NULL, event_category_type STRING NOT NULL, scope_type STRING NOT NULL, symbol STRING, "
        "sector_type STRING, title STRING NOT NULL, summary STRING, source_name STRING NOT NULL, reference_type STRING NOT NULL, "
        "reference STRING NOT NULL",
        "event_id",
    ),
}
