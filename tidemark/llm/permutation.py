"""Keyed permutation of 0 .. n-1 as a column expression: a Feistel network with cycle walking.

The network works on pairs (x, y) of residues modulo a and b with a * b just above n. A result of n or
more is put through the network again; at most a - 1 values lie out there, so few rows ever walk.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, functions as F

PRIME = 2147483647
ROUNDS = 8
WALKS = 24


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Two keys below PRIME for each round."""
    digests = (hashlib.sha256(f"{seed}:{r}".encode()).digest() for r in range(ROUNDS))
    return [(int.from_bytes(d[:8], "big") % PRIME, int.from_bytes(d[8:16], "big") % PRIME) for d in digests]


def domain(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def permuted(row: str, n: int, seed: int) -> Column:
    """The slot of row number ``row`` (a long column below n; n below 2^61).

    Beyond 24 walks the value would stay out of range: for n up to 600 no cycle is that long, and for
    larger n the chance is below (2 / sqrt(n))^24 a row.
    """
    a, b = domain(n)
    keys = ", ".join(f"named_struct('c', {c}L, 'd', {d}L)" for c, d in round_keys(seed))
    mixed = f"((s.y + k.c) % {PRIME} * ((s.y + k.c) % {PRIME}) % {PRIME} * (s.y % {PRIME}) + k.d) % {PRIME}"
    # each round swaps the halves and their moduli; after an even number of rounds they are back in place
    step = f"named_struct('x', s.y, 'y', (s.x + {mixed}) % s.m, 'm', s.w, 'w', s.m)"

    def once(v: str) -> str:
        start = f"named_struct('x', {v} div {b}L, 'y', {v} % {b}L, 'm', {a}L, 'w', {b}L)"
        return f"aggregate(array({keys}), {start}, (s, k) -> {step}, s -> s.x * {b}L + s.y)"

    return F.expr(f"aggregate(sequence(1, {WALKS}), {once(row)}, (v, i) -> IF(v < {n}L, v, {once('v')}))")


def permuted_sql(n: str, rows: str, seed: int, walks: int = 3) -> str:
    """The same in SQL: common table expressions ending in ``slots`` (columns of ``rows``, and slot).

    ``n`` names a one-row table (n, a, b), ``rows`` a table with row_no.
    """
    parts, last = [f"w0 AS (SELECT r.*, row_no AS v, n, a, b FROM {rows} r, {n})"], "w0"
    for walk in range(walks + 1):
        test = "TRUE" if walk == 0 else "v >= n"
        parts.append(f"w{walk}r0 AS (SELECT *, v // b AS x, v % b AS y, a AS m, b AS w FROM {last})")
        for r, (c, d) in enumerate(round_keys(seed)):
            mixed = f"((y + {c}) % {PRIME} * ((y + {c}) % {PRIME}) % {PRIME} * (y % {PRIME}) + {d}) % {PRIME}"
            parts.append(f"w{walk}r{r + 1} AS (SELECT * EXCLUDE (x, y, m, w), y AS x, (x + {mixed}) % m AS y, w AS m, m AS w FROM w{walk}r{r})")
        last = f"w{walk + 1}"
        parts.append(f"{last} AS (SELECT * EXCLUDE (x, y, m, w, v), CASE WHEN {test} THEN x * b + y ELSE v END AS v FROM w{walk}r{ROUNDS})")
    return ",\n".join([*parts, f"slots AS (SELECT * EXCLUDE (v, n, a, b), v AS slot FROM {last})"])
