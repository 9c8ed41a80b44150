"""Named queries over the test tables, each with the equivalent SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _needs(text: str, seen: dict[str, None]) -> None:
    for name in CTES:
        if name not in seen and re.search(rf"\b{name}\b", text):
            _needs(CTES[name], seen)
            seen[name] = None


def sql(body: str) -> str:
    """SQL text with the shared common table expressions it names, in dependency order."""
    seen: dict[str, None] = {}
    _needs(body, seen)
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in seen)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


def query(key: str, oracle: str | None = None):
    """Register a query under its key."""

    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return keep


# Exact decimal ties (prices divided by 80, 160, ...) fall on either side of a rounding step
# depending on the engine's last bit; a small shift before rounding puts them on one side.
TIE_SHIFT = 1.7e-9


def r(column: Column | str, places: int = 6) -> Column:
    """Rounded double without negative zero, so both engines print the same value."""
    col = F.col(column) if isinstance(column, str) else column
    return F.round(col.cast("double") + TIE_SHIFT, places) + F.lit(0.0)


def rs(expr: str, places: int = 6) -> str:
    """The SQL twin of :func:`r`."""
    return f"(round(CAST({expr} AS DOUBLE) + CAST({TIE_SHIFT} AS DOUBLE), {places}) + 0.0)"


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: r(n, places) for n in names})


def rlist(*names: str, places: int = 6) -> str:
    return ", ".join(f"{rs(n, places)} AS {n}" for n in names)
