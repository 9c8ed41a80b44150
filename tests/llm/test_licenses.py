import math
import random
import re
import time

import pytest

from brute import LOW
from tidemark.llm import licenses as L

SCHEMA = "doc_id bigint, text string"


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    blocks = set()
    for label, t, names in L.TEMPLATES:
        step = L.block_step(t)
        for b in range(0, len(w), step):
            window = set(w[b : b + 2 * step])
            share = len(window & set(t.split())) / len(set(t.split()))
            if share >= L.THRESHOLD and window >= set(names.split()):
                blocks.add((label, b, share))
    base = sorted({label for _, label in places})
    labels = sorted({*base, *(x[0] for x in blocks)})
    score = 1.0 if places else max([0.0, *(x[2] for x in blocks)])
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), score, blocks)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    pool = [w for _, t, _ in L.TEMPLATES[:7] for w in t.split()] + [f"x{i}" for i in range(60)]
    texts = [None, "", "   ", "Under the MIT license", "under the\nmit-license; UNDER THE MIT LICENSE", "CC-BY-NC 4.0, all rights reserved", "мит under the mit licenseé",
             "rights reserved all", "w " * 30_000 + "Released under the MIT License. " + "w " * 5_000]
    for _ in range(250):
        words = rng.choices(pool, k=rng.randint(0, 120))
        if rng.random() < 0.6:
            notice = [w for w in rng.choice(L.TEMPLATES)[1].split() if rng.random() < 0.9]
            at = rng.randint(0, len(words))
            words[at:at] = notice
        texts.append(rng.choice([" ", "\n", ", "]).join(words))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, labels string, row int")
    got = {r["doc_id"]: r for r in L.scanned(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        have = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"],
                {(b["label"], b["first_word"], b["share"]) for b in r["blocks"] or []})
        assert have[:6] == brute(t)[:6] and have[6] == pytest.approx(brute(t)[6]) and have[7] == brute(t)[7], t


def test_empty_and_repeated_rows(spark):
    assert L.scanned(spark.createDataFrame([], SCHEMA)).count() == 0
    got = L.scanned(spark.createDataFrame([(1, "cc by nc")] * 3 + [(None, "cc by nc")], SCHEMA)).collect()
    assert [r["base_labels"] for r in got] == ["cc-by-nc"] * 4


def test_licenses_that_share_wording_are_told_apart(spark):
    body = {label: t for label, t, _ in L.TEMPLATES[7:]}
    texts = ["released under the Apache License", "licensed under CC BY 4.0", "licensed under CC BY-SA 4.0", "Licensed under CC BY-NC 4.0!", "intro " * 500 + body["mit"].title() + " outro" * 300,
             "x " * 77 + body["isc"], body["gpl-3"].replace("gnu", "acme"), "y " * 1000 + body["apache-2"]]
    got = {r["doc_id"]: r["labels"] for r in L.scanned(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "cc-by-nc", 4: "mit", 5: "isc", 6: "", 7: "apache-2"}


def test_a_text_full_of_notices_costs_by_its_length(spark):
    docs = spark.createDataFrame([(1, "released under the mit license " * 40_000)], SCHEMA)
    start = time.monotonic()
    r = L.scanned(docs).first()
    assert (r["n_words"], r["n_base"], r["last_word"], r["labels"], len(r["blocks"])) == (200_000, 40_000, 199_996, "mit", math.ceil(200_000 / L.STEP))
    assert time.monotonic() - start < 40  # 2,000 notices took a minute when hits were copied for each of them
