"""Row checks: required fields, enums, rejects and table contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.symbols import event_id_fallback
from ..functions.times import parse_ts_et
from ..schemas import TABLES

# Allowed labels of event overview rows.
INFORMATION_ROLES = ("lagging_evidence", "prior_signal")
EVENT_CATEGORIES = ("macro_data", "macro_news", "sector_news", "symbol_news", "sec_filing", "option_abnormal_activity", "equity_abnormal_activity")
SCOPE_TYPES = ("macro", "sector", "symbol")
REFERENCE_TYPES = ("web_url", "sec_file_path", "internal_artifact_path", "source_reference")


def is_missing(column: Column) -> Column:
    return column.isNull() | (F.trim(column.cast("string")) == "")


def missing_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a missing required field, and which one comes first."""
    reason = F.coalesce(*[F.when(is_missing(F.col(c)), F.lit(c)) for c in required])
    return df.withColumn("missing_field", reason).where(F.col("missing_field").isNotNull())


def require(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Stop the job on the first row with a missing required field."""
    for c in required:
        ok = F.when(is_missing(F.col(c)), F.raise_error(F.lit(f"{c} is required")).cast(df.schema[c].dataType))
        df = df.withColumn(c, ok.otherwise(F.col(c)))
    return df


def reject(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first condition that holds, null for kept rows."""
    reason = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in reasons.items()])
    return df.withColumn("reject_reason", reason)


def reject_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))


def _enum(df_value: Column, allowed: Sequence[str], name: str, strict: bool) -> Column:
    text = F.lower(F.trim(F.coalesce(df_value, F.lit(""))))
    good = F.when(text.isin(*allowed), text)
    if not strict:
        return good
    return good.otherwise(F.raise_error(F.lit(f"{name} must be one of {sorted(allowed)}")).cast("string"))


def normalize_events(df: DataFrame, strict: bool = True) -> DataFrame:
    """Event overview rows: ids, New York times, checked labels.

    ``strict`` stops the job on a bad row; otherwise the bad field is null and
    ``bad_field`` names it.
    """

    def text(*names: str) -> Column:
        found = [F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in df.columns]
        return F.coalesce(*found, F.lit("")) if found else F.lit("")

    def needed(value: Column, message: str) -> Column:
        if not strict:
            return F.nullif(value, F.lit(""))
        return F.when(value != "", value).otherwise(F.raise_error(F.lit(message)).cast("string"))

    reference = text("reference", "event_link_url", "source_reference", "sec_file_path")
    stamp = text("event_time")
    ident = F.coalesce(
        F.nullif(text("event_id"), F.lit("")),
        event_id_fallback(F.nullif(text("event_category_type"), F.lit("")), text("event_time", "available_time"), text("symbol"), reference),
    )
    rows = df.select(
        ident.alias("event_id"),
        parse_ts_et(needed(stamp, "event_time is required")).alias("event_time"),
        parse_ts_et(text("available_time", "event_time")).alias("available_time"),
        _enum(text("information_role_type"), INFORMATION_ROLES, "information_role_type", strict).alias("information_role_type"),
        _enum(text("event_category_type"), EVENT_CATEGORIES, "event_category_type", strict).alias("event_category_type"),
        _enum(text("scope_type"), SCOPE_TYPES, "scope_type", strict).alias("scope_type"),
        F.nullif(F.upper(text("symbol")), F.lit("")).alias("symbol"),
        F.nullif(text("sector_type"), F.lit("")).alias("sector_type"),
        needed(text("title", "headline"), "each event requires title/headline").alias("title"),
        text("summary").alias("summary"),
        text("source_name", "source").alias("source_name"),
        _enum(F.coalesce(F.nullif(text("reference_type"), F.lit("")), F.lit("source_reference")), REFERENCE_TYPES, "reference_type", strict).alias("reference_type"),
        needed(reference, "each event requires reference/link/path").alias("reference"),
    )
    if strict:
        return rows
    checked = ("event_time", "information_role_type", "event_category_type", "scope_type", "title", "reference_type", "reference")
    return rows.withColumn("bad_field", F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in checked]))


def contract_check(df: DataFrame, table: str) -> DataFrame:
    """Check a table against its contract: one row per rule with the number of violations.

    NOT NULL rules cost one pass; key uniqueness one partial aggregation on the key.
    """
    spec = TABLES[table]
    schema = spec.schema
    missing = [c for c in schema.names if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks columns {missing}")
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    required = [f.name for f in schema.fields if not f.nullable]
    nulls = typed.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    rules = nulls.select(F.explode(F.array(*[
        F.struct(F.lit(f"not_null:{c}").alias("rule"), F.col(c).alias("violations")) for c in required])).alias("r")).select("r.*")
    dup = (
        typed.groupBy(*spec.key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("unique:" + ",".join(spec.key)).alias("rule"), "violations")
    )
    return rules.unionByName(dup)
