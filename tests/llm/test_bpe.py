import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tidemark.llm.bpe import Model, encoded  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "   ", "<|endoftext|>hi<|startoftext|>  It's DON'T we'll 12345 ½ ² ΑΣ ΣΑΣ İstanbul ﬁ Ünïcode é", "aaaa" * 300, "!!!???" * 300,
       "日本語 한국어 🤗 \x1c\x1d​　x\x00y\x85z\xa0w", "Å Å ẛ̣ 'S 'LL l'll", "<|endoftext|", "x" * 50_000]


@pytest.fixture(scope="module")
def model():
    with open(PATH, encoding="utf-8") as f:
        return Model(f.read())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_ids_equal_the_library(model, library):
    rng = random.Random(8)
    pieces = [s.removesuffix("</w>") for s in model.vocab]
    texts = ODD + ["".join(rng.choices(pieces, k=4)) + " " + " ".join(rng.choices(pieces, k=6)) for _ in range(3000)]
    flat, cut = model.encode(texts)
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, a, b, e in zip(texts, cut[:-1], cut[1:], want):
        assert flat[a:b].tolist() == e.ids, text[:80]
        assert model.decode(flat[a:b]) == library.decode(e.ids, skip_special_tokens=False)


def test_both_ways_of_merging_agree(model, monkeypatch):
    import tidemark.llm.bpe as bpe

    words = ["".join(random.Random(i).choices("abenrtho", k=30)) for i in range(60)]
    short = [model.merge(w) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert short == [model.merge(w) for w in words]


def test_forgetting_changes_nothing(model, monkeypatch):
    import tidemark.llm.bpe as bpe

    texts = ["the quick brown fox", "jumps over the lazy dog"]
    before = [x.tolist() for x in model.encode(texts)]
    monkeypatch.setattr(bpe, "KEEP", 0)
    assert [x.tolist() for x in model.encode(texts)] == before


def test_rows(spark, library):
    rows = [(1, None, 5), (2, "", 6), (3, "Hello, world", 7), (3, "Hello, world", 7), (None, "x y", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = encoded(docs, PATH).orderBy("doc_id").collect()
    assert len(got) == 5 and got[1]["ids"] == [] and got[1]["decoded"] == "" and got[2]["ids"] == []
    assert got[3]["ids"] == library.encode("Hello, world", add_special_tokens=False).ids and got[3] == got[4]
    assert encoded(docs.limit(0), PATH).count() == 0


def test_words_are_guessed_and_merged_together(library, monkeypatch):
    """Words of up to SHORT bytes take no steps of their own, whether their guess holds or not."""
    with open(PATH, encoding="utf-8") as f:
        model = Model(f.read())
    alone = []
    for name in ("_guess", "merge"):
        monkeypatch.setattr(model, name, lambda word, own=getattr(model, name): alone.append(word) or own(word))
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abehnortéß'.1", k=rng.randint(1, 20))) for _ in range(200)) for _ in range(30)]
    texts += [" lead", "trail\n", "\x0bboth ", "<|endoftext|> in<|startoftext|>side ", "日本語 and more", "no\xa0break"]
    flat, cut = model.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert not alone


def test_ids_in_bytes(spark):
    docs = spark.createDataFrame([(1, "Hello, world"), (2, None), (3, "")] + [(k, f"text {k} of many") for k in range(4, 40)], "doc_id bigint, text string").coalesce(1)
    lists = encoded(docs, PATH, with_text=False).orderBy("doc_id").collect()
    packed = encoded(docs, PATH, with_text=False, in_bytes=True).orderBy("doc_id").collect()
    assert [b"".join(i.to_bytes(4, "little") for i in r["ids"]) for r in lists] == [bytes(r["ids"]) for r in packed]
