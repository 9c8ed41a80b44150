"""Scores on a stream: ticks in any order give what the batch operators give on all of them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bars import trade_bars
from tidemark.operators.windows import trailing_z
from tidemark.streaming.scores import score_batch, score_stream, scored_bars

SCHEMA = "symbol string, ts timestamp_ntz, seq int, price double, size int"
METRICS = ("bar_volume", "bar_close")


def ticks(seed=9):
    rng = random.Random(seed)
    rows, start = [], datetime(2024, 1, 2, 9, 30)
    for symbol, share in (("HOT", 400), ("B", 60), ("C", 12)):
        for _ in range(share):
            at = start + timedelta(days=rng.randint(0, 5), minutes=rng.randint(0, 389), seconds=rng.randint(0, 59))
            rows.append((symbol, at, len(rows), rng.randint(10, 900) / 4, rng.choice([None, 1, 2, 50])))
    return rows


def table(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)) for r in df.collect()), key=repr)


def expected(df, n):
    return table(trailing_z(trade_bars(df), ["symbol"], "bucket", ["bucket"], METRICS, n))


def test_shuffled_late_replay_equals_the_batch_answer(spark, tmp_path):
    rows = ticks()
    random.Random(1).shuffle(rows)  # every file holds ticks of all days
    for i in range(3):
        part = rows[i::3] + ([(None, rows[0][1], -1, 1.0, 1), ("B", None, -2, 1.0, 1)] if i == 1 else [])
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = score_stream(stream, str(tmp_path / "out"), str(tmp_path / "check"), 4, METRICS)
    assert query.awaitTermination(200) and query.lastProgress["batchId"] == 2
    got = table(scored_bars(spark, str(tmp_path / "out")))
    assert got == expected(spark.createDataFrame(rows, SCHEMA), 4) and len(got) > 80


def test_a_late_tick_moves_later_scores_and_a_repeated_batch_moves_nothing(spark, tmp_path):
    path, rows = str(tmp_path / "out"), sorted(ticks(3), key=lambda r: r[1])
    late = [("C", datetime(2024, 1, 1, 10, 0), 9999, 7.25, 40), ("NEW", datetime(2024, 1, 9, 10, 0), 10000, 1.5, None)]
    score_batch(spark.createDataFrame(rows, SCHEMA), 0, path, 3, METRICS)
    before = table(scored_bars(spark, path))
    assert before == expected(spark.createDataFrame(rows, SCHEMA), 3)
    for _ in range(2):  # as after a failure
        score_batch(spark.createDataFrame(late, SCHEMA), 1, path, 3, METRICS)
        after = table(scored_bars(spark, path))
        assert after == expected(spark.createDataFrame(rows + late, SCHEMA), 3)
    assert len(after) == len(before) + 2 and len(set(after) & set(before)) < len(before)


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    score_batch(spark.createDataFrame([], SCHEMA), 0, path, 3)
    with pytest.raises(FileNotFoundError):
        scored_bars(spark, path)
    score_batch(spark.createDataFrame(ticks()[:20], SCHEMA), 1, path, 3)
    n = scored_bars(spark, path).count()
    score_batch(spark.createDataFrame([], SCHEMA), 2, path, 3)
    assert scored_bars(spark, path).count() == n == trade_bars(spark.createDataFrame(ticks()[:20], SCHEMA).where(F.col("symbol").isNotNull())).count()
