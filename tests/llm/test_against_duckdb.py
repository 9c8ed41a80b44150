"""Every query with SQL against DuckDB, and the shape of the others, on the smallest tables."""

import os

import pytest

from compare import compare, duck
from tidemark.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables absent")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, key):
    status, note, _ = compare(spark, duck(SMALL), key, QUERIES[key], ORACLE[key], SMALL)
    assert status == "ok", note


def test_there_is_a_query_for_each_operator():
    assert sorted(int(k.split("_")[0][2:]) for k in QUERIES) == list(range(1, 14))
