"""Every row of the pipeline's last stage, digests included, against the tokenizers library."""

import hashlib
import os

import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline as pipeline  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables absent")


def test_all_rows_of_the_last_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    rows = pipeline.run(spark, SMALL).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert rows
    for r, e in zip(rows, library.encode_batch([texts[r["doc_id"]] for r in rows], add_special_tokens=False)):
        names = " ".join(library.id_to_token(i) for i in e.ids)
        assert r["ids"] == e.ids and r["n_tokens"] == len(e.ids)
        assert r["ids_sha256"] == sha(" ".join(map(str, e.ids))) and r["decoded_sha256"] == sha(names)
