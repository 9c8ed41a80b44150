"""Row numbers, the keyed permutation, shards and token output."""

import random
import zlib

import pytest

from tidemark.llm.common import number_rows
from tidemark.llm.permutation import permuted
from tidemark.llm.sharding import sharded
from tidemark.llm.token_output import END, PAD, materialised, numbered_sequences, read_shards, write_shards

SCHEMA = "doc_id bigint, text string"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 24, 101, 997])
def test_permutation_is_one_to_one(spark, n):
    got = [r[0] for r in spark.range(n).select(permuted("id", n, 5)).collect()]
    assert sorted(got) == list(range(n))
    if n > 100:
        assert got != [r[0] for r in spark.range(n).select(permuted("id", n, 6)).collect()] and sum(a == b for a, b in zip(got, range(n))) < 10


def test_rows_are_numbered_in_order(spark):
    rows = [(random.Random(1).randint(0, 50), f"{i % 7}") for i in range(500)] + [(None, None)] * 3
    got = number_rows(spark.createDataFrame(rows, SCHEMA).repartition(5), ["doc_id", "text"], "t").orderBy("row_no").collect()
    assert [r["row_no"] for r in got] == list(range(503))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    assert [(r["doc_id"], r["text"]) for r in got] == sorted(rows, key=key)


def test_shards(spark):
    rows = [(i, f"é{i % 5}" * (i % 9)) for i in range(500)] + [(3, "dup"), (3, "dup"), (None, None), (9000, "x" * 200_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, slot int")
    got = sharded(docs).collect()
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(s) for s in by_shard.values()]
    assert len(got) == len(rows) and len(by_shard) == 24 and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    assert sorted(map(str, got)) == sorted(map(str, sharded(docs.repartition(7)).collect()))
    assert sharded(docs.limit(0)).count() == 0


def test_shards_hold_every_sequence_and_can_be_resumed(spark, tmp_path):
    rows = [(i, "ab é" * (i % 40)) for i in range(200)] + [(5, "ab é" * 5), (None, None), (7, ""), (999, "long " * 20_000)]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, offset int").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs, path = spark.read.parquet(f"{tmp_path}/docs"), f"file://{tmp_path}/out"
    index = write_shards(docs, path, length=16, records=50)
    got = sorted(read_shards(index, path, length=16).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in got] == list(range(len(got)))
    assert all(r["shard"] == r["slot"] // 50 and r["at"] == r["slot"] % 50 * 16 for r in got)
    files = sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".bin")
    assert len(files) == -(-len(got) // 50) and all(p.stat().st_size % 16 == 0 for p in files)
    whole = b"".join(p.read_bytes() for p in files)
    assert whole[16 * 77 : 16 * 78].rstrip(bytes([PAD])) == bytes(got[77]["tokens"])  # a seek finds slot 77
    # put back in scan order, the sequences spell out every document; each tells where it begins
    rows_, n = numbered_sequences(docs, 16)
    by_row = sorted(rows_.collect(), key=lambda r: r["row_no"])
    assert n == len(got) == len(by_row) and sorted((bytes(r["tokens"]), r["doc_id"], r["offset"]) for r in by_row) == sorted(
        (bytes(r["tokens"]), r["doc_id"], r["offset"]) for r in got)
    spelled = b"".join(bytes(r["tokens"]) for r in by_row)
    assert sorted(spelled.split(bytes([END]))[:-1]) == sorted((t or "").encode() for _, t in rows)
    texts = {i: (t or "").encode() + bytes([END]) for i, t in rows}
    for r in got:
        if r["doc_id"] not in (5, 7):  # ids of two rows
            start = texts[r["doc_id"]][r["offset"] :][:16]
            assert bytes(r["tokens"]).startswith(start)
    order = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert sum(a <= b for a, b in zip(order, order[1:])) < 0.95 * len(order)


def test_token_output_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/docs")
    assert materialised(spark.read.schema(SCHEMA).parquet(f"{tmp_path}/docs")).count() == 0
