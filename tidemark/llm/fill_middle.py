"""Fill-in-the-middle: lines of a text cut into prefix, middle and suffix, and put in another order.

A text is split into units, each a line with its line feed. Two cuts, drawn from the digest of ``seed:doc_id``, make
three pieces; a form says in which order they are written, each behind its tag:

    psm    <P> prefix <S> suffix <M> middle
    spm    <S> suffix <P> prefix <M> middle
    plain  the text as it is: empty texts, texts that hold a tag, and what ``rate`` leaves alone

Everything in a task is pyarrow.compute on a slice of a batch: units as list arrays, flattened with the index of
their parent, numbered within it, filtered by role, put back into lists and joined. A slice has about SLICE bytes of
text; a longer text is a slice of its own. No rows move between tasks.

Null texts are empty; a null doc_id draws from the digest of ``seed:``. Repeated rows come out as often as they
stand in the table, alike if doc_id and text are. Only doc_id and text are read, so other columns may have any name.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TAG = "<[PSM]>"
SLICE = 4 << 20  # bytes of text
ROW = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _cuts_of_slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows that have about SLICE bytes together."""
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield at, to
        at = to


def _remainder(x: pa.Array, y: pa.Array) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, y), y))


def _lists(counts: pa.Array, values: pa.Array) -> pa.ListArray:
    """Lists of so many of ``values`` each, in order."""
    ends = np.concatenate(([0], np.cumsum(counts.to_numpy(), dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def pieces(text: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """(number of units, prefix, middle, suffix) of each text; h1 and h2 draw the cuts."""
    split = pc.split_pattern(text, "\n")  # behind the last line feed stands one more, empty item
    parent, item = pc.list_parent_indices(split), pc.list_flatten(split)
    size, first = pc.list_value_length(split), pa.array(split.offsets.to_numpy()[:-1] - split.offsets.to_numpy()[0])
    ordinal = pc.subtract(pa.array(np.arange(len(item))), pc.take(first, parent).cast(pa.int64()))
    closing = pc.equal(ordinal, pc.subtract(pc.take(size, parent), 1).cast(pa.int64()))
    unit = pc.if_else(closing, item, pc.binary_join_element_wise(item, "\n", ""))
    keep = pc.invert(pc.and_(closing, pc.equal(pc.binary_length(item), 0)))
    unit, parent, ordinal = (x.filter(keep) for x in (unit, parent, ordinal))
    n = pa.array(np.bincount(parent.to_numpy(), minlength=len(text)).astype(np.int64))
    more = pc.add(n, 1)
    x, y = _remainder(h1, more), _remainder(h2, more)
    low, high = pc.min_element_wise(x, y), pc.max_element_wise(x, y)
    role = pc.add(pc.greater_equal(ordinal, pc.take(low, parent)).cast(pa.int8()), pc.greater_equal(ordinal, pc.take(high, parent)).cast(pa.int8()))
    counts = (low, pc.subtract(high, low), pc.subtract(n, high))
    prefix, middle, suffix = (pc.binary_join(_lists(c, unit.filter(pc.equal(role, r))), "") for r, c in enumerate(counts))
    return n, prefix, middle, suffix


def _transform(rate: int, spm: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in _cuts_of_slices(pc.binary_length(texts).to_numpy()):
                text = texts.slice(a, b - a).cast(pa.string())
                h1, h2, h3, h4 = (batch.column(i).slice(a, b - a) for i in range(2, 6))
                n, prefix, middle, suffix = pieces(text, h1, h2)
                hundred = pa.scalar(100, pa.int64())
                plain = pc.or_(pc.or_(pc.equal(n, 0), pc.match_substring_regex(text, TAG)), pc.greater_equal(_remainder(h3, hundred), rate))
                back = pc.less(_remainder(h4, hundred), spm)
                joined = pc.binary_join_element_wise(
                    pc.if_else(back, SUFFIX, PREFIX), pc.if_else(back, suffix, prefix), pc.if_else(back, PREFIX, SUFFIX), pc.if_else(back, prefix, suffix), MIDDLE, middle, "")
                chars = [pc.if_else(plain, None, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
                form = pc.if_else(plain, "plain", pc.if_else(back, "spm", "psm"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), n, form, *chars, pc.if_else(plain, text, joined)],
                                                 ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return of


def transformed(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain) and output of each document.

    ``rate`` percent of the documents are cut, ``spm`` percent of these in suffix-prefix-middle order, as the digest says.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *draws).mapInArrow(_transform(rate, spm), ROW)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        outputs, forms = batch.column("output"), batch.column("form")
        for a, b in _cuts_of_slices(pc.binary_length(outputs).to_numpy()):
            some, output, form = batch.slice(a, b - a), outputs.slice(a, b - a).cast(pa.string()), forms.slice(a, b - a)
            cut = pc.not_equal(form, "plain")
            split = pc.split_pattern_regex(output.filter(cut), TAG)  # nothing before the first tag, then three pieces
            one, two, middle = (pc.list_element(split, i) for i in (1, 2, 3))
            back = pc.equal(form.filter(cut), "spm")
            text = pc.binary_join_element_wise(pc.if_else(back, two, one), middle, pc.if_else(back, one, two), "")
            yield pa.RecordBatch.from_arrays([*some.columns, pc.replace_with_mask(output, cut, text)], [*some.schema.names, "restored"])


def restored(rows: DataFrame) -> DataFrame:
    """The rows with ``restored``, the text rebuilt from output and form alone."""
    return rows.mapInArrow(_restore, f"{ROW}, restored string")
