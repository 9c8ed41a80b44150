"""The pipeline's stages against brute force, each over what the one before it kept."""

import os

import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline as pipeline  # noqa: E402
from brute import near_groups, targets, words  # noqa: E402
from tidemark.llm.quality import quality_scores  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables absent")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs.collect())
        assert i == len(pipeline.STAGES) - 1 or docs.columns == columns
    good, single, mix, ids = kept
    # some fifty labelled rows train it here; test_quality measures held-out accuracy
    whole = spark.read.parquet(f"{SMALL}/documents.parquet")
    judged = quality_scores(whole, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert 0 < len(good) < whole.count() and {r["doc_id"] for r in good} == {r["doc_id"] for r in judged if r["predicted"]}
    groups = near_groups({r["doc_id"]: r["text"] for r in good})
    assert {r["doc_id"] for r in single} == {i for i, (_, c) in groups.items() if i == c}
    sizes, taken, times = {}, {}, {}
    for r in single:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    for r in mix:
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    longest = max(len(words(r["text"])) for r in single)
    assert max(times.values()) <= 2 and all(abs(taken.get(s, 0) - t) <= longest for s, t in targets(sizes).items())
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in mix}
    assert len(ids) == len(mix)
    for r in ids[:60]:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_run_returns_the_last_stage(spark):
    assert pipeline.run(spark, SMALL).columns == ["doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
