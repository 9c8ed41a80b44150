import hashlib
import random
from itertools import combinations

import pytest

from tidemark.llm import simhash as S

SCHEMA = "doc_id bigint, text string"


def test_near_search_equals_all_pairs(spark):
    rng = random.Random(6)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:30]:
        for flips in (0, 1, 2, 3, 4, 5):
            x = p
            for bit in rng.sample(range(64), flips):
                x ^= 1 << bit
            prints.append(x)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    pairs = {(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    df = spark.createDataFrame([(p,) for p in signed + signed[:5]], "fingerprint bigint")
    assert {r[0] for r in S.with_near(df).collect()} == {x for p in pairs for x in p}
    got = [tuple(r) for r in S.near_queries(df, df).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs | {(b, a) for a, b in pairs}


def votes(hashes):
    if not hashes:
        return 0
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_fingerprints_count_every_vote(spark):
    texts = [(1, "a b c a b c a b"), (2, "a  b\tc a b c a b"), (3, "one"), (4, ""), (5, "Ä ö ü " * 40_000)]
    df = spark.createDataFrame(texts, SCHEMA)
    hashes = {r[0]: [h & (1 << 64) - 1 for h in r[1]] for r in df.select("doc_id", S.term_hashes("text")).collect()}
    got = {r["doc_id"]: r["fingerprint"] & (1 << 64) - 1 for r in S.fingerprints(df, ["doc_id"]).collect()}
    assert got == {i: votes(h) for i, h in hashes.items()} and got[1] == got[2] and got[4] == 0
    assert [len(hashes[i]) for i in (1, 3, 4, 5)] == [7, 1, 0, 119_999]


@pytest.mark.parametrize("ids", [range(5), range(-700, 700, 3), [0, 300, 5000, 10**15, -(10**12)], [9]])
def test_edited_texts_follow_descending_ids(spark, ids):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("ab é 中", k=rng.randint(0, 30)))) for i in ids]
    got = {r["doc_id"]: r for r in S.compared(spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, run string")).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, t), (j, after) in zip(order, order[1:] + order[:1]):
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        like = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 64
        assert r["near_edited"] == like(r["fingerprint"], r["edited_fingerprint"]) and r["near_next"] == like(r["fingerprint"], got[j]["fingerprint"])


def test_nulls_repeated_ids_and_empty(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c d"), (None, "x"), (None, None), (2, None)]
    got = S.compared(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and len({r["fingerprint"] for r in got if r["n_chars"] == 3}) == 2
    assert S.compared(spark.createDataFrame([], SCHEMA)).count() == 0
