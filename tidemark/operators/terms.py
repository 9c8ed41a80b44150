"""Which of many terms stand in a text, by an index of how the terms begin instead of one alternation.

An alternation tries every term at every position of a text. Here each term is filed under its first letters, as many as
:func:`filed_size` says: the whole term up to EXACT letters, at least two thirds of a longer one. At a position of a text the first
HEAD letters tell which sizes are worth a look, and the letters of each such size find the terms that begin so, in equi-joins
on hashes; a term found is compared letter by letter. So a text costs by its length, not by the length of the list.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..shared import staged

HEAD = 5  # first letters that tell whether any term may begin here
EXACT = 12  # terms up to so many letters are filed whole
PIECE = 128  # characters of a text that are looked through together
CHUNK = 512  # pieces of a text that go to one task
FEW = 2_000_000  # terms whose index goes to all tasks at a time, of NARROW characters at most on average; longer lists go in slices
NARROW = 100
LEAST = 16  # terms in a slice at least


def clean_terms(terms: DataFrame, term: str = "term") -> DataFrame:
    """Terms as they are searched: lower case, without wildcard, backslash and quote, each once; empty ones drop."""
    cleaned = F.regexp_replace(F.lower(F.col(term).cast("string")), r"[%\\']", "")
    return terms.select(cleaned.alias("term")).where("term IS NOT NULL AND term <> ''").distinct()


def filed_size(size: Column) -> Column:
    """How many first letters a term of ``size`` letters is filed under: 1 to 12, 16, 24, 32, 48, 64, 96, ..."""
    power = F.call_function("shiftleft", F.lit(1), F.length(F.bin(size.cast("bigint"))) - 1)
    half = power + F.call_function("shiftright", power, F.lit(1))
    return F.when(size <= EXACT, size).when(size >= half, half).otherwise(power)


def cut(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """``text`` to rows of its parts of ``size`` characters, each with the head of the next one, so a term across the cut is seen whole."""
    rest = [c for c in df.columns if c != text]
    parts = df.select(*rest, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)).alias("_parts"))
    joined = F.transform("_parts", lambda c, i: F.concat(c, F.coalesce(F.substring(F.try_element_at("_parts", i + 2), 1, overlap), F.lit(""))))
    return parts.select(*rest, F.posexplode_outer(joined).alias("_place", text))


def chunks(df: DataFrame, keys: Sequence[str], text: Column, step: int, overlap: int) -> DataFrame:
    """(keys as _k0, _k1, ..., _text): lower-cased texts dealt over tasks; a long one spreads."""
    names = [f"_k{i}" for i in range(len(keys))]
    whole = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.lower(text).alias("_text")).where("_text <> ''")
    return cut(whole, "_text", step * CHUNK, overlap).repartition(*names, "_place").drop("_place")


def held(texts: DataFrame, index: DataFrame, step: int, overlap: int, heads: Sequence[int]) -> DataFrame:
    """The chunks' columns and a term, for each place where a term of the index stands."""
    names = [c for c in texts.columns if c != "_text"]
    starts = index.groupBy("_head").agg(F.collect_set("_size").alias("_sizes"))
    pieces = cut(texts, "_text", step, overlap).withColumnRenamed("_text", "_piece")
    at = pieces.select(*names, "_piece", F.explode_outer(F.sequence(F.lit(1), F.least(F.char_length("_piece"), F.lit(step)))).alias("_at"))
    begun = lambda size: F.xxhash64(F.substring("_piece", F.col("_at"), size))
    at = at.withColumn("_n", F.explode(F.array(*[F.lit(n) for n in heads])) if len(heads) > 1 else F.lit(heads[0]))
    at = at.withColumn("_head", begun(F.col("_n"))).join(F.broadcast(starts), "_head")
    at = at.select(*names, "_piece", "_at", F.explode_outer("_sizes").alias("_n")).withColumn("_key", begun(F.col("_n")))
    found = at.join(F.broadcast(index.select("_key", "term")), "_key")
    return found.where(F.substring("_piece", F.col("_at"), F.char_length("term")) == F.col("term")).select(*names, "term")


def _hits(df: DataFrame, keys: Sequence[str], text: Column, terms: DataFrame, term: str, wanted: Sequence[str]) -> DataFrame:
    """The distinct ``wanted`` columns of keys and term, slice by slice of the list; without the term, a row may come once a slice."""
    listed = staged(clean_terms(terms, term), "terms")
    size = F.char_length("term")
    longest, heads, many, letters = listed.agg(
        F.max(size), F.sort_array(F.collect_set(F.least(size, F.lit(HEAD)))), F.count(F.lit(1)), F.sum(size)).first()
    longest, few = longest or 1, max(FEW, LEAST)
    slices = max(1, -(-many // few), -(-(letters or 0) // (few * NARROW)))
    step = max(PIECE, longest)
    begin = lambda n: F.xxhash64(F.substring("term", F.lit(1), n))
    index = listed.select("term", filed_size(size).alias("_size"))
    index = index.select("term", "_size", begin(F.least(size, F.lit(HEAD))).alias("_head"), begin(F.col("_size")).alias("_key"))
    texts = chunks(df, keys, text, step, longest - 1)
    out = [F.col(f"_k{keys.index(c)}").alias(c) if c in keys else F.col(c) for c in wanted]
    if slices == 1:
        return held(texts, index, step, longest - 1, heads or [HEAD]).select(*out).distinct()
    texts = staged(texts, "chunks")  # one slice after the other, so that one index at a time is held
    part = F.pmod(F.xxhash64(F.lit("slice"), "term"), F.lit(slices))
    done = [staged(held(texts, index.where(part == i), step, longest - 1, heads).select(*out).distinct(), "hits") for i in range(slices)]
    return reduce(DataFrame.unionByName, done)


def term_hits(df: DataFrame, keys: Sequence[str], text: Column, terms: DataFrame, term: str = "term") -> DataFrame:
    """The keys of a row and a term, once for every term that the row's lower-cased text holds anywhere.

    ``terms`` has a row per term. Rows of equal keys count as one text each, their terms once; null keys are equal.
    Null and empty texts hold nothing, and without terms nothing is found. Texts of any length are cut into overlapping
    chunks, so one long text spreads over tasks and no list of a text's terms is gathered. Only texts and hits are shuffled.
    """
    return _hits(df, list(keys), text, terms, term, [*keys, "term"])


def with_any_term(df: DataFrame, key: str, text: Column, terms: DataFrame, term: str = "term") -> DataFrame:
    """The rows whose text holds a term of the list; ``key`` tells rows apart, a row without it is left out."""
    return df.join(_hits(df, [key], text, terms, term, [key]), key, "left_semi")
