"""The tail-aligned ratio query gives the whole tail of every end."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables absent")
def test_every_end_has_its_whole_tail(spark):
    rows = entry.queries()["tail_aligned_ratio"](spark, SMALL)
    assert rows.columns == ["numerator", "denominator", "n_num", "n_den", "k", "ratio"]
    ends = rows.groupBy("numerator", "denominator", "n_num", "n_den").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"))
    want = F.least("n_num", "n_den", F.lit(220))
    assert ends.count() > 100
    assert ends.where((F.col("n") != want) | (F.col("low") != 0) | (F.col("high") != want - 1)).isEmpty()
