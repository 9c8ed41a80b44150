import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ODD = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "<", "|", "a<|", "", None, "x\ny<|im_end|>\n", "\\n", "$1 \\1", "<<||>>", "é" * 50]


def read(spark, rows, **sizes):
    got = chat.read_back(chat.windows(spark.createDataFrame(rows, SCHEMA), **sizes)).collect()
    return {r["conv_id"]: r for r in got}


def expected(rows):
    out = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        n, turns, loss = out.get(c, (0, "", ""))
        out[c] = (n + 1, turns + f"{role or ''}\n{text or ''}\n", loss + (text or "") * (role == "assistant"))
    return out


def same(got, rows):
    want = expected(rows)
    assert {c: (r["n_turns"], r["turns_text"], r["loss_text"]) for c, r in got.items()} == want


def test_escaping_is_reversible(spark):
    rows = [(i, 0, role, text) for i, text in enumerate(ODD) for role in ("assistant",)]
    rows += [(100 + i, 0, role, "x") for i, role in enumerate(["a\nb", "\\", "\\n", "\\\\n\n", "<|im_end|>", "a\x00\\\x00b", "", None])]
    same(read(spark, rows), rows)


def test_every_turn_is_new_once_and_windows_keep_the_budget(spark):
    rng = random.Random(1)
    rows = []
    for c in range(25):
        system = rng.random() < 0.5
        for t in range(rng.randint(1, 30)):
            role = "system" if t == 0 and system else rng.choice(["user", "assistant", "tool"])
            rows.append((c, t * rng.choice([1, 1, 300]), role, " ".join(["w"] * (rng.randint(0, 12) if rng.random() < 0.95 else 400))))
    rows += [(3, 5, "assistant", "again")] * 3 + [(None, None, None, None), (None, 2, "assistant", "x")]
    made = chat.windows(spark.createDataFrame(rows, SCHEMA), budget=100, history=20, system=20).collect()
    half = 30
    for w in made:
        assert w["tokens"] <= 100 or any(len((t or "").split()) + chat.OVERHEAD > half for c, _, _, t in rows if c == w["conv_id"])
        assert all(w["text"][s["start"] - 1] == "\n" and w["text"][s["start"] + s["length"] :].startswith("<|im_end|>\n") for s in w["loss"])
    assert len(made) > 60 and any(w["n_repeated"] > 1 for w in made)
    same(read(spark, rows, budget=100, history=20, system=20), rows)


def test_later_windows_repeat_the_system_turn(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "w " * 20) for t in range(1, 20)]
    made = chat.windows(spark.createDataFrame(rows, SCHEMA), budget=120, history=30, system=20).collect()
    assert len(made) > 3 and all(w["text"].startswith("<|im_start|>system\nbe brief<|im_end|>\n") for w in made)
    same(read(spark, rows, budget=120, history=30, system=20), rows)


def test_hot_conversation_and_long_text(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(3000)] + [(8, 0, "assistant", "word " * 100_000)]
    got = read(spark, rows)
    same(got, rows)
    assert hashlib.sha256(got[7]["turns_text"].encode()).hexdigest() == hashlib.sha256(expected(rows)[7][1].encode()).hexdigest()


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.windows(empty)).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "hi")], SCHEMA).withColumns({c: F.lit("x") for c in ("key", "block", "tokens", "start", "bucket", "window")})
    assert chat.windows(rows).count() == 1


def test_no_window_exceeds_the_budget_but_a_single_turn(spark):
    rng = random.Random(5)
    rows = []
    for c in range(30):
        words = rng.choice([0, 5, 30, 59, 90, 120, 600])  # of the system turn
        at = rng.choice([0, 0, 4])
        for t in range(25):
            role = "system" if t == at and words else rng.choice(["user", "assistant"])
            rows.append((c, t, role, " ".join([f"{c}.{t}"] * (words if role == "system" else rng.choice([1, 8, 20, 60, 110, 150]) if c % 3 else rng.randint(1, 20)))))
    for sizes in ({"budget": 120, "history": 30}, {"budget": 120, "history": 200}, {"budget": 100, "history": 0, "system": 20}):
        made = chat.windows(spark.createDataFrame(rows, SCHEMA), **sizes).collect()
        for w in made:
            assert w["tokens"] <= sizes["budget"] or (w["n_new"], w["n_repeated"]) == (1, 0)
        same(read(spark, rows, **sizes), rows)


def test_system_turn_is_retained_up_to_half_the_budget(spark):
    for words, kept in ((56, True), (57, False), (600, False)):  # 4 tokens more each
        rows = [(1, 0, "system", "s " * words)] + [(1, t, ("user", "assistant")[t % 2], "w " * 10) for t in range(1, 40)]
        made = sorted(chat.windows(spark.createDataFrame(rows, SCHEMA), budget=120, history=20).collect(), key=lambda w: w["window"])
        assert len(made) > 4 and [w["text"].startswith("<|im_start|>system") for w in made] == [True] + [kept] * (len(made) - 1)


def test_windows_are_filled_on_plain_chat(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], "w " * (20 + t % 30)) for t in range(400)]
    made = chat.windows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(w["tokens"] <= chat.BUDGET for w in made)
    assert sum(w["tokens"] for w in made) / len(made) > 0.8 * chat.BUDGET


def test_token_counts_of_the_caller(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], "one two", n) for t, n in enumerate([100, 5, None, 0, -3, 40, 40, 40, 90])]
    made = chat.windows(spark.createDataFrame(rows, SCHEMA + ", size int"), budget=120, history=10, tokens="size").collect()
    assert all(w["tokens"] <= 120 for w in made) and sum(w["n_new"] for w in made) == 9 and len(made) >= 4
    same(read(spark, [r[:4] for r in rows], budget=120, history=10), [r[:4] for r in rows])
