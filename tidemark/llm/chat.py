"""Chat formatting: conversations as windows of bounded length with a mask for the loss.

Turns are numbered by prefix sums of their tokens. The room of a conversation's spans is the budget less its system
turn and HISTORY; a turn of more than half the room is a span of its own, and the others that start in the same bucket of starts make
one. Buckets are as wide as the room less the longest turn (less half the room where a turn is longer), so a span never exceeds the room.
A window is a span with the system turn, repeated where it isn't new, and the turns before it that fit into HISTORY tokens and
the budget. No window exceeds the budget but that of a single turn that does so alone. Two rules keep it so: a system turn of
more than SYSTEM tokens or half the budget stands in its own place only, and beside a long turn that leaves too little for the system
turn, or for history, these are left out. Repeated turns carry no loss, so every assistant text is a target once.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles a backslash is put between ``<`` and ``|``, after those
that stand there already, so no control string can come from a text; removing one restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, stage

BUDGET, HISTORY, SYSTEM = 512, 128, 256  # tokens of a window, of repeated turns, and of the longest system turn to repeat
BLOCK = 256  # turn numbers in a block of prefix sums
OVERHEAD = 4  # tokens of a turn beside its text's words
TURN = "struct<role:string,text:string>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unrole(role: Column) -> Column:
    # backslash pairs stand aside while \n becomes a line break
    plain = F.replace(unescaped(role), F.lit("\\\\"), F.lit("\\\x00"))
    return F.replace(F.replace(plain, F.lit("\\n"), F.lit("\n")), F.lit("\\\x00"), F.lit("\\"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, system: int = SYSTEM, tokens: str | None = None) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text), a row each.

    ``tokens`` names a column with the tokens of each turn, template included; where it is null, and without it, they are
    the words and OVERHEAD. A turn counts for one token at least.

    Returns conv_id, window (a sortable struct), text, n_repeated (leading turns that carry no loss), n_new,
    tokens and loss, an array of (start, length) in characters of ``text``, one for each new assistant text.
    Null text and role count as empty. Turns are ordered by turn (null first), equal ones by role and text;
    repeated rows are turns of their own. A null conv_id is one conversation. An empty table has no windows. Further columns drop.
    """
    if budget < 4:
        raise ValueError("budget must be at least 4 tokens")
    counted = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) + OVERHEAD
    counted = counted if tokens is None else F.coalesce(F.col(tokens), counted)
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                        F.greatest(counted.cast("bigint"), F.lit(1).cast("bigint")).alias("tokens"))
    rows = rows.withColumns({"key": F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
                             "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))})
    blocks = rows.groupBy("key", "block").agg(F.sum("tokens").alias("sum"), F.max("tokens").alias("most"))
    # the earliest system turn, by its size
    first = rows.where("role = 'system'").groupBy("key").agg(F.min(F.struct("turn", "text", "tokens"))["tokens"].alias("kept"))
    first = first.where(F.col("kept") <= min(system, budget // 2))
    each = W.partitionBy("key")
    blocks = blocks.select("key", "block", (F.sum("sum").over(each.orderBy("block")) - F.col("sum")).alias("base"), F.max("most").over(each).alias("most"))
    blocks = blocks.join(first, "key", "left").withColumn("kept", F.coalesce("kept", F.lit(0).cast("bigint")))
    room = F.greatest(budget - history - F.col("kept"), F.expr(f"({budget} - kept) div 2"))
    blocks = blocks.withColumn("room", room).withColumn("short", F.expr("room div 2"))  # the longest turn that shares a span
    blocks = blocks.withColumn("width", F.col("room") - F.least("most", "short")).drop("room", "most")
    rows = rows.join(blocks, ["key", "block"])
    order = W.partitionBy("key", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(W.unboundedPreceding, 0)
    start = F.col("base") + F.sum("tokens").over(order) - F.col("tokens")
    rows = rows.withColumn("start", start).withColumns({"bucket": F.floor(F.col("start") / F.col("width")), "long": F.col("tokens") > F.col("short")})

    turn = ["conv_id", "start", "role", "text", "tokens"]
    rows = stage(rows.select("key", "bucket", "long", "width", "kept", *turn), "turns")  # four branches read it
    spans = rows.groupBy("key", "bucket", "long").agg(F.min("start").alias("first"), F.sum("tokens").alias("total"), F.max("kept").alias("kept"))
    spans = spans.withColumn("kept", F.when(F.col("total") + F.col("kept") <= budget, F.col("kept")).otherwise(0))
    spans = spans.withColumn("reach", F.least(F.lit(history), budget - F.col("total") - F.col("kept")))
    # the earliest system turn, and every later span repeats it
    lead = rows.where("role = 'system'").groupBy("key").agg(F.min_by(F.struct(*turn), "start").alias("s"))
    far = F.floor((F.col("start") + history) / F.col("width"))
    past = rows.select("key", *turn, F.explode(F.sequence("bucket", far)).alias("bucket"))
    past = past.join(spans.drop("kept"), ["key", "bucket"]).where((F.col("start") < F.col("first")) & (F.col("first") - F.col("start") <= F.col("reach")))
    new = rows.select("key", "bucket", "long", *turn, F.lit(True).alias("new"))
    past = past.join(lead.select("key", F.col("s.start").alias("at")), "key", "left").where("at IS NULL OR start <> at")
    past = past.select("key", "bucket", "long", *turn, F.lit(False).alias("new"))
    again = spans.where("kept > 0").join(lead, "key").where("s.start < first").select("key", "bucket", "long", *(f"s.{c}" for c in turn), F.lit(False).alias("new"))
    parts = new.unionByName(past).unionByName(again)

    # a window's turns have at most the budget in tokens and each one at least, so the list is bounded
    lists = parts.groupBy("key", "bucket", "long").agg(
        F.sort_array(F.collect_list(F.struct("start", "new", "role", "text", "tokens"))).alias("turns"), F.max("conv_id").alias("conv_id"))
    piece = lambda t: F.struct(
        F.concat(F.lit("<|im_start|>"), _role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"),
        (t["new"] & (t["role"] == "assistant")).alias("target"))
    lists = lists.withColumn("pieces", F.transform("turns", piece))
    end = "<|im_end|>\n"
    ends = F.expr(f"""aggregate(pieces, named_struct('at', 0, 'spans', array_remove(array(named_struct('start', 0, 'length', 0)), named_struct('start', 0, 'length', 0))),
        (a, p) -> named_struct('at', a.at + char_length(p.head) + char_length(p.body) + {len(end)}, 'spans',
          IF(p.target, array_append(a.spans, named_struct('start', a.at + char_length(p.head), 'length', char_length(p.body))), a.spans)), a -> a.spans)""")
    return lists.select(
        "conv_id", F.struct("bucket", "long").alias("window"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(end))), "").alias("text"),
        F.size(F.filter("turns", lambda t: ~t["new"])).alias("n_repeated"), F.size(F.filter("turns", lambda t: t["new"])).alias("n_new"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda a, t: a + t["tokens"]).alias("tokens"), ends.alias("loss"))


def read_turns(text: Column) -> Column:
    """The (role, text) turns of a window's text."""
    whole = F.slice(F.split(text, r"<\|im_end\|>\n"), 1, F.size(F.split(text, r"<\|im_end\|>\n")) - 1)
    cut = lambda t: F.instr(t, "\n")
    return F.transform(whole, lambda t: F.struct(
        _unrole(F.substring(t, F.lit(13), cut(t) - 13)).alias("role"), unescaped(F.substring(t, cut(t) + 1, F.char_length(t))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation hold: new turns in order, and the texts under the loss mask.

    Returns conv_id, n_turns, turns_text (role, line break, text, line break of every turn), loss_text and
    formatted_chars. Each conversation's own text is put together in one row.
    """
    turns = F.slice(read_turns(F.col("text")), F.col("n_repeated") + 1, F.col("n_new"))
    parts = formatted.select(
        "conv_id", "window", "n_new", F.char_length("text").cast("bigint").alias("chars"),
        F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["length"]))), "").alias("loss"))
    joined = parts.groupBy("conv_id").agg(
        F.sum("n_new").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"))
    return joined.select("conv_id", "n_turns", F.array_join("w.turns", "").alias("turns_text"), F.array_join("w.loss", "").alias("loss_text"), "formatted_chars")
