"""Words of whole texts as numpy arrays, a slice of an Arrow batch at a time.

Texts are handled as UTF-8 bytes: ``A-Z`` is lower-cased and words end at ASCII white space, so a
byte is never part of another character. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # bytes of text handled at once; a longer text is a slice of its own
U = np.uint64
_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=U) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15)
_UNBASE = U(pow(int(_BASE), -1, 1 << 64))
_STEP = _rng.integers(1, 1 << 63, 16, dtype=U) * U(2) + U(1)
_powers = [np.ones(1, U), np.ones(1, U)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(n, base, U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span: a polynomial by prefix sums, shifted back to position 0."""
    if not len(starts):
        return np.zeros(0, U)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    return (np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)), offsets


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of rows of about SLICE bytes."""
    data, offsets = raw_texts(column)
    at, n = 0, len(column)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        to = min(to, n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def runs(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal non-zero kind that lie within one text."""
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.ones(len(kind) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(kind))]
    change[inner] = True
    edges = np.flatnonzero(change)
    keep = kind[edges[:-1]] != 0
    return edges[:-1][keep], edges[1:][keep]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every lower-cased word, first word of each text and the total)."""
    low = LOWER[data]
    starts, ends = runs((~SPACE[low]).astype(np.uint8), offsets)
    return span_hashes(low, starts, ends), np.searchsorted(starts, offsets)


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, whatever text they stand in."""
    if len(words) < n:
        return np.zeros(0, U)
    total = np.zeros(len(words) - n + 1, U)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * _STEP[j]
    return mix(total + U(n))


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, distinct sorted shingles of each row): runs of ``size`` words, or the whole shorter text as one."""
    for at, to, data, offsets in slices(column):
        words, first = word_hashes(data, offsets)
        full = sequence_hashes(words, size)
        sets = []
        for k in range(to - at):
            a, b = int(first[k]), int(first[k + 1])
            if b - a >= size:
                sets.append(np.unique(full[a : b - size + 1]))
            else:
                sets.append(sequence_hashes(words[a:b], b - a) if b > a else np.zeros(0, U))
        yield at, sets
