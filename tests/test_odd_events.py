"""Scalar queries over events that the small tables lack: whole seconds, values of zero and below."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, duck
from tidemark.functions.numbers import safe_log_ratio

KINDS = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])


def write(folder, rows):
    names = KINDS.names
    pq.write_table(pa.Table.from_pylist([dict(zip(names, row)) for row in rows], KINDS), f"{folder}/events.parquet")
    return str(folder)


def same(spark, d, key):
    status, note, _ = compare(spark, duck(d), key, entry.queries()[key], entry.oracle_sql()[key], d)
    assert status == "ok", note


def test_whole_seconds_have_six_digits(spark, tmp_path):
    at = dt.datetime(2024, 1, 5, 10, 0, 7)
    times = [at, at.replace(microsecond=1), at.replace(microsecond=250000), None]
    d = write(tmp_path, [(i, t, 1, "view", 1.0, '{"k": 1}') for i, t in enumerate(times)])
    same(spark, d, "iso_et")
    assert entry.queries()["iso_et"](spark, d).where("event_id = 0").first()["text"] == "2024-01-05T05:00:07.000000-05:00"


@pytest.mark.parametrize("value", [0.0, -0.0, -3.5, 5e-324, 2.0, None, float("nan"), float("inf")])
def test_log_ratio_of_any_value(spark, tmp_path, value):
    at = dt.datetime(2024, 1, 5)
    d = write(tmp_path, [(k, at, 1, "view", value, f'{{"k": {k}}}') for k in range(7)])
    same(spark, d, "safe_log_ratio")


def test_features_have_no_logarithm_of_zero(spark):
    df = spark.sql("SELECT double(0) AS a, double(2) AS b")
    assert df.select(safe_log_ratio(F.col("a"), F.col("b")).alias("x")).first()["x"] is None
