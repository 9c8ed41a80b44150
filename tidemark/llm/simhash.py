"""SimHash fingerprints of whole texts and the search for near ones.

Terms are pairs of neighbouring words, each weighing as often as it stands in the text. The 64 bits of a
term's hash vote for or against the bits of the fingerprint. Votes are counted by sums over packed longs:
one long holds the counts of two bits, so a text may have 2^32 terms.

Search: fingerprints within RADIUS bits agree on at least BLOCKS - RADIUS of BLOCKS bit blocks. For every
choice of that many blocks there is a table keyed by them; equal keys are compared bit by bit. A bit whose votes tie is 0.
Texts of any length are one row of terms each, exploded and summed map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import components, number_rows, stage

SPACE = r"[\x20\x09-\x0D]+"
RADIUS, BLOCKS = 3, 6
RUN = 256  # ids in a run of neighbours
CHUNK = 1024  # fingerprints of a bucket that are looked through at once
_PAIR = (1 << 32) + 1


def term_hashes(text: str) -> Column:
    """Hashes of a text's neighbouring word pairs; of the word, if it is the only one."""
    return F.expr(f"""aggregate(array(array_remove(split(lower({text}), '{SPACE}'), '')), array(0L), (none, w) ->
        CASE size(w) WHEN 0 THEN array() WHEN 1 THEN array(xxhash64(w[0]))
        ELSE zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w) - 1), (x, y) -> xxhash64(x, y)) END)""".replace("\\", "\\\\"))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row for each ``keys`` with ``fingerprint`` (long); ``keys`` must tell the rows apart. No words: 0."""
    terms = texts.select(*keys, F.explode_outer(term_hashes(text)).alias("h"))
    packed = [F.sum(F.expr(f"shiftrightunsigned(h, {i}) & {_PAIR}L")).alias(f"v{i}") for i in range(32)]
    votes = terms.groupBy(*keys).agg(F.count("h").alias("n"), *packed)
    low = [F.expr(f"IF(2 * (v{i} & 4294967295L) > n, {1 << i}L, 0L)") for i in range(32)]
    high = [F.expr(f"IF(2 * shiftrightunsigned(v{i}, 32) > n, shiftleft(1L, {i + 32}), 0L)") for i in range(32)]
    bits = low[0]
    for b in (*low[1:], *high):
        bits = bits.bitwiseOR(b)
    return votes.select(*keys, F.coalesce(bits, F.lit(0)).cast("bigint").alias("fingerprint"))


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """A mask for each choice of blocks - radius bit blocks, as signed longs."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = (sum(c) for c in combinations(one, blocks - radius))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def block_tables(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, keep: Sequence[str] = ()) -> DataFrame:
    """Each fingerprint once for every block table: columns fingerprint, ``keep``, place, key.

    Joins of it are sort-merge joins: Spark takes an exploded table for as large as before and would broadcast it.
    """
    cells = [F.struct(F.lit(i).alias("place"), F.expr(f"fingerprint & ({m}L)" if m != -(1 << 63) else f"fingerprint & (-{(1 << 63) - 1}L - 1L)").alias("key"))
             for i, m in enumerate(block_masks(radius, blocks))]
    return prints.select("fingerprint", *keep, F.explode(F.array(*cells)).alias("c")).select("fingerprint", *keep, "c.place", "c.key").hint("merge")


def with_near(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """The distinct fingerprints that have another one within ``radius`` bits."""
    tables = block_tables(prints.select("fingerprint").distinct(), radius, blocks)
    other = tables.select(F.col("fingerprint").alias("other"), "place", "key")
    near = [tables["place"] == other["place"], tables["key"] == other["key"], F.col("fingerprint") != F.col("other"),
            F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= radius]
    return tables.join(other, near, "left_semi").select("fingerprint").distinct()


def near_queries(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All (fingerprint, other) of a stated query set within ``radius`` bits, each pair once."""
    left = block_tables(queries.select("fingerprint").distinct(), radius, blocks)
    right = block_tables(prints.select("fingerprint").distinct(), radius, blocks).withColumnRenamed("fingerprint", "other")
    pairs = left.join(right, ["place", "key"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= radius)
    return pairs.where("fingerprint <> other").select("fingerprint", "other").distinct()


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs (fingerprint < other) of distinct fingerprints within ``radius`` bits, each once, native.

    A pair that agrees in several block tables counts in the first of them only.
    """
    tables = block_tables(prints.select("fingerprint").distinct(), radius, blocks)
    other = tables.select(F.col("fingerprint").alias("other"), "place", "key")
    differ = F.col("fingerprint").bitwiseXOR(F.col("other"))
    first = F.expr(f"{_first_table('fingerprint', 'other', radius, blocks)} = place")
    pairs = tables.join(other, ["place", "key"]).where((F.col("fingerprint") < F.col("other")) & (F.bit_count(differ) <= radius)).where(first)
    return pairs.select("fingerprint", "other")


def _first_table(a: str, b: str, radius: int, blocks: int) -> str:
    """The first block table in which fingerprints ``a`` and ``b`` agree (from 0)."""
    masks = ", ".join(f"{m}L" if m != -(1 << 63) else f"(-{(1 << 63) - 1}L - 1L)" for m in block_masks(radius, blocks))
    return f"array_position(transform(array({masks}), m -> (({a} ^ {b}) & m) = 0L), true) - 1"


def neighbours(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """For each distinct fingerprint of the rows of ``prints``: n_near and near_class.

    n_near counts the other rows within ``radius`` bits of a row, those with the same fingerprint too. near_class is the
    smallest fingerprint (as a signed long) that links of at most ``radius`` bits lead to.

    A bucket (equal keys of a block table) is cut into arrays of about CHUNK fingerprints, and each of its fingerprints
    meets the arrays: one row for an array, not for a pair. A pair counts in the first table in which it agrees. For the classes a
    link is dropped where a smaller fingerprint of the same array is near both its ends: the two links to that one, or what
    stands for them in turn, connect the ends, so a group of near copies keeps about one link a member and array.
    """
    held = stage(prints.groupBy("fingerprint").agg(F.count("*").alias("n")), "prints-held")
    tables = block_tables(held, radius, blocks, ["n"])
    sizes = tables.groupBy("place", "key").agg(F.count("*").alias("m")).where("m > 1")
    cut = tables.join(sizes, ["place", "key"]).withColumn("chunk", F.pmod(F.xxhash64("fingerprint"), F.ceil(F.col("m") / CHUNK)))
    arrays = cut.groupBy("place", "key", "chunk").agg(F.array_sort(F.collect_list(F.struct(F.col("fingerprint").alias("f"), "n"))).alias("others"))
    met = cut.select("place", "key", "fingerprint").join(arrays.hint("merge"), ["place", "key"])
    near = f"x -> x.f <> fingerprint AND bit_count(x.f ^ fingerprint) <= {radius}"
    first = f"{_first_table('fingerprint', 'x.f', radius, blocks)} = place"
    links = f"""transform(filter(near, x -> x.f > fingerprint AND {first} AND NOT exists(near, h -> h.f < fingerprint AND bit_count(h.f ^ x.f) <= {radius})), x -> x.f)"""
    found = met.select("fingerprint", F.expr(f"""transform(array(filter(others, {near})), near -> named_struct(
        'm', aggregate(filter(near, x -> {first}), 0L, (s, x) -> s + x.n), 'links', {links}))[0]""").alias("r"))
    found = stage(found.select("fingerprint", "r.*").where("m > 0"), "near")
    more = found.groupBy("fingerprint").agg(F.sum("m").alias("m"))
    links = found.select(F.col("fingerprint").alias("a"), F.explode("links").alias("b"))
    classes = components(links, "near-classes").select(F.col("node").alias("fingerprint"), "component")
    return held.join(more, "fingerprint", "left").join(classes, "fingerprint", "left").select(
        "fingerprint", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_near"), F.coalesce("component", "fingerprint").alias("near_class"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal bits."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def with_edits(docs: DataFrame) -> DataFrame:
    """Every row with its edited text: the last third gives way to the start of the next row's text.

    Rows follow each other by descending doc_id (equal ids by text, null ids last), the first follows the
    last. They meet in runs of RUN ids, and the border of a run gets the first text of the next run, so no task needs the whole
    order. Returns run, at (place in the run), next_run, next_at, doc_id, text, edited.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    run = F.coalesce(F.expr(f"-(doc_id div {RUN})"), F.lit((1 << 63) - 1)).alias("run")
    order = W.partitionBy("run").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    placed = rows.select(run, "doc_id", "text").select(
        "*", F.row_number().over(order).alias("at"), F.lead(F.struct("text")).over(order).alias("after"))
    runs = stage(number_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).select(run).distinct(), ["run"], "runs"), "run-order")
    n = runs.count()
    follows = runs.select(F.col("run").alias("next_run"), F.pmod(F.col("row_no") - 1, F.lit(max(1, n))).alias("row_no"))
    follows = runs.join(follows, "row_no").select("run", "next_run")
    heads = placed.where("at = 1").select(F.col("run").alias("next_run"), F.col("text").alias("head")).join(follows, "next_run")
    size = F.char_length("text")
    donor, third = F.coalesce(F.col("after")["text"], F.col("head")), F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - third), F.substring(donor, F.lit(1), third))
    return placed.join(heads, "run", "left").select(
        "run", "at", F.when(F.col("after").isNull(), F.col("next_run")).otherwise(F.col("run")).alias("next_run"),
        F.when(F.col("after").isNull(), 1).otherwise(F.col("at") + 1).alias("next_at"), "doc_id", "text", edited.alias("edited"))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, its edited text, and how like they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (16 hex digits), near_edited,
    near_next, near_found, n_near (other rows whose fingerprint lies within RADIUS bits, equal ones included; found if
    there are any) and near_class (16 hex digits: the fingerprint that names the class of rows linked so), a row for each row of ``docs``.
    Null text counts as empty; texts without words have fingerprint 0. Further columns drop.
    """
    both = with_edits(docs).select(
        "run", "at", "next_run", "next_at", "doc_id", F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("t"))
    keys = ["run", "at", "next_run", "next_at", "doc_id", "n_chars", "edited_sha256"]
    prints = fingerprints(both.select(*keys, "t.which", "t.text"), [*keys, "which"])
    rows = prints.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("own"),
                                     F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited"))
    rows = stage(rows, "fingerprints")
    after = rows.select(F.col("run").alias("next_run"), F.col("at").alias("next_at"), F.col("own").alias("next"))
    near = neighbours(rows.select(F.col("own").alias("fingerprint"))).withColumnRenamed("fingerprint", "own")
    rows = rows.join(after.hint("merge"), ["next_run", "next_at"]).join(near, "own")  # a row for each document, never broadcast
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return rows.select("doc_id", "n_chars", "edited_sha256", text("own").alias("fingerprint"), text("edited").alias("edited_fingerprint"),
                       likeness("own", "edited").alias("near_edited"), likeness("own", "next").alias("near_next"),
                       (F.col("n_near") > 0).alias("near_found"), "n_near", text("near_class").alias("near_class"))
