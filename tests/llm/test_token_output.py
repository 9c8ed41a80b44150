"""Shards of tokenizer ids."""

import numpy as np
import pytest

from tidemark.llm.common import stage
from tidemark.llm.token_output import layout, numbered_sequences, read_shards, write_shards

SCHEMA = "doc_id bigint, ids array<int>"


@pytest.mark.parametrize("vocabulary, wide", [(49_408, 2), (65_534, 2), (65_535, 4), (250_000, 4)])
def test_shards_hold_tokenizer_ids(spark, tmp_path, vocabulary, wide):
    rows = [(i, [(i * 31 + k * 7919) % vocabulary for k in range(i % 40)]) for i in range(200)]
    rows += [(1000, [vocabulary - 1, 0] * 900), (1001, []), (1002, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/docs")
    docs, path = spark.read.parquet(f"{tmp_path}/docs"), f"file://{tmp_path}/out"
    index = write_shards(docs, path, length=16, records=50, vocabulary=vocabulary)
    got = sorted(read_shards(index, path, length=16, vocabulary=vocabulary).collect(), key=lambda r: r["slot"])
    kind, end, pad = layout(vocabulary)
    assert kind.itemsize == wide and [r["slot"] for r in got] == list(range(len(got)))
    files = sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".bin")
    stored = np.concatenate([np.frombuffer(p.read_bytes(), kind) for p in files])
    assert len(stored) == 16 * len(got)
    for r in got:
        record = stored[16 * r["slot"] : 16 * r["slot"] + 16].tolist()
        assert record == r["tokens"] + [pad] * (16 - r["n_tokens"]) and r["at"] == r["slot"] % 50 * 16 * wide
    numbered, n = numbered_sequences(docs, 16, vocabulary)
    by_row = sorted(numbered.collect(), key=lambda r: r["row_no"])
    assert n == len(got) and sorted(np.frombuffer(r["tokens"], kind).tolist() for r in by_row) == sorted(r["tokens"] for r in got)
    spelled, doc = [], []
    for t in np.frombuffer(b"".join(bytes(r["tokens"]) for r in by_row), kind).tolist():
        if t == end:
            spelled.append(doc)
            doc = []
        else:
            doc.append(t)
    assert not doc and sorted(spelled) == sorted(ids or [] for _, ids in rows)


@pytest.mark.parametrize("ids", [[100], [-1], [3, None]])
def test_ids_beyond_the_vocabulary_stop(spark, ids):
    docs = stage(spark.createDataFrame([(1, ids)], SCHEMA), "docs")
    with pytest.raises(Exception, match="ids must be 0 to 99"):
        numbered_sequences(docs, 16, 100)[0].collect()


def test_query_writes_the_tokenizers_ids(spark):
    tokenizers, public_tokenizers = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    from tidemark.llm.queries import op9_token_output

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    want = sum(len(e.ids) + 1 for e in library.encode_batch(texts, add_special_tokens=False))
    assert sum(r["n_tokens"] for r in op9_token_output(spark, "/root/testdata/sf0.001").collect()) == want


@pytest.mark.parametrize("vocabulary", [None, 49_408])
def test_every_document_is_found_in_the_index(spark, tmp_path, vocabulary):
    # short, empty, null, repeated and long documents; most begin and end inside a record
    rows = [(i, "ab" * (i % 4)) for i in range(300)] + [(7, "copy")] * 40 + [(8, ""), (9, None), (None, "none"), (500, "long " * 300)]
    if vocabulary is not None:
        rows = [(i, None if t is None else [ord(c) * 300 for c in t]) for i, t in rows]
    spark.createDataFrame(rows, SCHEMA if vocabulary else "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs, path = spark.read.parquet(f"{tmp_path}/docs"), f"file://{tmp_path}/out"
    index = write_shards(docs, path, length=16, records=50, vocabulary=vocabulary)
    by_row = {r["row_no"]: r for r in read_shards(index, path, length=16, vocabulary=vocabulary).collect()}
    _, end, _ = layout(vocabulary)
    found = []
    for r in by_row.values():
        for doc_id, start, n in r["begins"]:
            stream, at = list(r["tokens"])[start:], r["row_no"] + 1
            while len(stream) <= n:
                stream += list(by_row[at]["tokens"])
                at += 1
            assert stream[n] == end
            found.append((doc_id is not None, doc_id or 0, stream[:n]))
    want = [(i is not None, i or 0, list(t.encode()) if isinstance(t, str) else t or []) for i, t in rows]
    assert sorted(found) == sorted(want)


def test_uneven_and_empty_splits(spark, tmp_path, monkeypatch):
    """One split holds all rows, three are empty; then several shards a task."""
    from tidemark.llm import token_output as T

    rows = [(i, [(i * 7 + k) % 500 for k in range(i % 90)]) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    for tasks, splits in ((16_384, docs), (2, docs.repartitionById(4, (docs["doc_id"] * 0 + 2).cast("int"))), (3, docs.repartitionById(5, (docs["doc_id"] % 5).cast("int")))):
        monkeypatch.setattr(T, "TASKS", tasks)
        path = f"file://{tmp_path}/out-{tasks}"
        index = write_shards(splits, path, length=16, records=20, vocabulary=500)
        got = sorted(read_shards(index, path, length=16, vocabulary=500).collect(), key=lambda r: r["slot"])
        assert [r["slot"] for r in got] == list(range(len(got))) == sorted(r["row_no"] for r in got)
        assert sum(r["n_tokens"] for r in got) == sum(len(x) + 1 for _, x in rows)
        assert sorted(b["doc_id"] for r in got for b in r["begins"]) == list(range(400))


def test_empty_table_and_paths_without_scheme(spark, tmp_path):
    from tidemark.llm.common import uri

    path = f"file://{tmp_path}/none"
    assert write_shards(spark.createDataFrame([], SCHEMA), path, vocabulary=500).count() == 0
    assert uri(spark, str(tmp_path)) == f"file://{tmp_path}" == uri(spark, f"file:{tmp_path}")
    assert uri(spark, "hdfs://host:9000/a") == "hdfs://host:9000/a"


def test_sequences_are_packed_on_their_way(spark, monkeypatch):
    """Staged sequences take less than the ids they hold; ids beyond the common ones and ids given as bytes come through."""
    from tidemark.llm import token_output as T

    staged, rng = {}, np.random.default_rng(5)
    monkeypatch.setattr(T, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    docs = [(i, np.minimum(rng.zipf(1.3, 900), 49_407).tolist()) for i in range(400)] + [(900, None), (901, [])]
    docs += [(1000 + i, list(range(i * 1000, i * 1000 + 1000))) for i in range(49)]
    lists = spark.createDataFrame(docs, SCHEMA).coalesce(2)
    found = []
    for wide in (lists, spark.createDataFrame([(i, None if x is None else np.array(x, "<i4").tobytes()) for i, x in docs], "doc_id bigint, ids binary").coalesce(2)):
        staged.clear()
        numbered, _ = numbered_sequences(wide, 1024, 49_408)
        rows = sorted((r["row_no"], bytes(r["tokens"])) for r in numbered.collect())
        assert sum(len(t) for _, t in rows) == 2 * sum(len(x or ()) + 1 for _, x in docs)
        size = sum(r["length"] for r in spark.read.format("binaryFile").load(staged["sequences"].inputFiles()).select("length").collect())
        assert size < 0.75 * sum(len(t) for _, t in rows)
        found.append(b"".join(t for _, t in rows))
    assert found[0] == found[1]


def test_bytes_that_are_no_ids_stop(spark):
    for ids, said in ((b"\x01\x00\x00", "4 bytes"), (b"\xff\xff\xff\xff", "ids must be 0 to 99")):
        with pytest.raises(Exception, match=said):
            numbered_sequences(stage(spark.createDataFrame([(1, ids)], "doc_id bigint, ids binary"), "docs"), 16, 100)
