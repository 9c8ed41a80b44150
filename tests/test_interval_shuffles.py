"""Interval joins shuffle the rows once, and give the same rows by either way."""

import pytest

from tidemark.operators import joins


@pytest.mark.parametrize("few", [8, 2, 0])
def test_rows_are_shuffled_once_and_all_found(spark, monkeypatch, few):
    monkeypatch.setattr(joins, "FEW_SPANS", few)
    rows = spark.sql("SELECT int(id % 7) AS k, timestamp_ntz'2024-01-01' + make_dt_interval(int(id % 90), 0, 0, 0) AS ts, id AS r FROM range(700)")
    spans = spark.sql("""SELECT int(id % 5) AS k, timestamp_ntz'2024-01-01' + make_dt_interval(int(id * 3), 0, 0, 0) AS lo,
      CASE WHEN id % 6 > 0 THEN timestamp_ntz'2024-01-01' + make_dt_interval(int(id * 3 + id % 11 - 1), 0, 0, 0) END AS hi, id AS s FROM range(22)""")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = joins.interval_join(rows, spans, ["k"], "ts", "lo", "hi")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted((x.r, x.s) for x in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = sorted((x.r, y.s) for x in rows.collect() for y in spans.collect() if x.k == y.k and x.ts >= y.lo and (y.hi is None or x.ts <= y.hi))
    assert got == want and len(want) > 300
    if few == 8:  # no key has more: rows and spans once each
        assert plan.count("Exchange hashpartitioning") == 2
