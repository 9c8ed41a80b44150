import hashlib
import random
import re

import pytest

from tidemark.llm import fill_middle as M

SCHEMA = "doc_id bigint, text string"


def brute(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text, text)
    form, output = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc_id, n, form, len(p), len(m), output, text)


def run(spark, rows, **options):
    return sorted(map(tuple, M.restored(M.transformed(spark.createDataFrame(rows, SCHEMA), **options)).collect()), key=repr)


def texts():
    rng = random.Random(4)
    bits = ["\n", "\n\n", "a", " word", "é", "😀", "<", "P>", "<S", "\r", " ", "\x00"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    return rows + [(None, "x\ny"), (None, None), (5, None), (5, ""), (6, "\n"), (7, "no line feed"), (8, "has <M> inside\n"), (9, "<P"), (9, "<P"), (9, "<P")]


@pytest.mark.parametrize("options", [{}, {"seed": 11, "rate": 60, "spm": 0}, {"rate": 0}, {"spm": 100}])
def test_equals_brute_force_and_restores(spark, options):
    rows = texts()
    got = run(spark, rows, **options)
    assert got == sorted((brute(*r, **options) for r in rows), key=repr)
    assert {r[2] for r in got} <= {"plain", "psm", "spm"}


def test_long_texts_and_slices(spark, monkeypatch):
    monkeypatch.setattr(M, "SLICE", 1000)  # most rows here are longer or share a slice
    rows = [(i, f"line {i}\n" * (i % 300)) for i in range(600)] + [(1000, "one line " * 200_000), (1001, "\n" * 200_000), (1002, "ab\n" * 300_000 + "end")]
    assert run(spark, rows) == sorted((brute(*r) for r in rows), key=repr)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    names = "doc_id bigint, text string, h1 string, n string, form string, output string, restored int, prefix_chars int"
    docs = spark.createDataFrame([(3, "a\nb\nc", "x", "y", "z", "o", 1, 2)], names)
    assert [tuple(r) for r in M.restored(M.transformed(docs)).collect()] == [brute(3, "a\nb\nc")]
