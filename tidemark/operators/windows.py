"""Trailing windows over a time series that may not fit one task.

A plain ``Window.partitionBy(symbol)`` is right for series whose length the calendar
bounds (daily bars). For long series :func:`rolling` numbers the rows of every key in
parallel, cuts them into blocks of equal size, lends each block the rows its frames look
back to, and windows inside blocks. Results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F


def index_rows(df: DataFrame, by: Sequence[str], ts: str, order: Sequence[str], chunk: str = "month", name: str = "rn") -> DataFrame:
    """Number rows 1..n per key in ``order`` without sorting a whole key in one task."""
    day = F.to_date(F.col(ts))
    rows = df.withColumn("_chunk", day if chunk == "day" else F.to_date(F.trunc(day, chunk)))
    sizes = rows.groupBy(*by, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order)
    return (
        rows.withColumn("_r", F.row_number().over(inside))
        .join(offsets, [*by, "_chunk"])
        .withColumn(name, F.col("_offset") + F.col("_r"))
        .drop("_chunk", "_r", "_offset")
    )


def rolling(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    order: Sequence[str],
    lookback: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    chunk: str = "month",
    block: int = 65_536,
) -> DataFrame:
    """Add trailing-frame columns that reach back at most ``lookback`` rows.

    ``columns`` receives the window (no frame set) and returns the expressions.
    """
    block = max(block, lookback)
    rows = index_rows(df, by, ts, order, chunk)
    home = F.floor((F.col("rn") - 1) / block)
    place = F.pmod(F.col("rn") - 1, F.lit(block))
    targets = F.when(place >= block - lookback, F.array(home, home + 1)).otherwise(F.array(home))
    lent = rows.withColumns({"_home": home, "_block": F.explode(targets)})
    spec = Window.partitionBy(*by, "_block").orderBy("rn")
    return lent.withColumns(columns(spec)).where(F.col("_block") == F.col("_home")).drop("_home", "_block", "rn")


def trailing(spec: WindowSpec, n: int, current: bool = True) -> WindowSpec:
    """The last ``n`` rows, with or without the current one."""
    return spec.rowsBetween(-(n - 1), 0) if current else spec.rowsBetween(-n, -1)


def full_window(value: Column, source: Column, spec: WindowSpec, n: int) -> Column:
    """``value`` only where the frame holds all ``n`` non-null rows."""
    return F.when(F.count(source).over(spec) == n, value)


def trailing_z(
    df: DataFrame, by: Sequence[str], ts: str, order: Sequence[str], metrics: Sequence[str], n: int, chunk: str = "month"
) -> DataFrame:
    """Z-score of each metric against its previous ``n`` non-null values, for every row on its own.

    Rows are numbered once. Metrics go long (missing ones aside, so histories compact), one rolling pass scores
    them, and they come back together by the row's number; the row's columns travel with its first metric.
    """
    rows = index_rows(df, by, ts, order, chunk, "_row")
    whole = F.struct(*[F.col(c) for c in df.columns])
    first = metrics[0]
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                      F.when(F.lit(m == first), whole).alias("whole")) for m in metrics]
    long = rows.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(ts).alias("_ts"), "_row", F.explode(F.array(*cells)).alias("_m"))
    long = long.select("*", "_m.*").drop("_m").withColumn("_has", F.col("value").isNotNull())
    keys = [f"_by{i}" for i in range(len(by))]

    def z(spec: WindowSpec) -> dict[str, Column]:
        past = trailing(spec, n, current=False)
        v = F.col("value")
        mean, std = F.avg(v).over(past), F.stddev_pop(v).over(past)
        return {"z": full_window(F.try_divide(v - mean, std), v, past, n) if n >= 2 else F.lit(None).cast("double")}

    scored = rolling(long, [*keys, "metric", "_has"], "_ts", ["_row"], n, z, chunk)
    wide = scored.groupBy(*keys, "_row").agg(
        F.first("whole", ignorenulls=True).alias("_whole"), *[F.max(F.when(F.col("metric") == m, F.col("z"))).alias(f"{m}_z") for m in metrics]
    )
    return wide.select("_whole.*", *[f"{m}_z" for m in metrics])


def wide_mean(df: DataFrame, spec: WindowSpec, value: str, sizes: dict[str, int], base: int) -> DataFrame:
    """Trailing means over wide frames from one narrow frame.

    A frame of n rows is n/base frames of ``base`` rows, found by lag, so a row costs
    base + n/base steps instead of n. Values are right where the frame is full.
    """
    df = df.withColumn("_m", F.avg(value).over(trailing(spec, base)))
    deepest = max(sizes.values()) // base
    df = df.withColumns({f"_m{j}": F.lag("_m", base * j).over(spec) for j in range(1, deepest)})
    out = {}
    for name, n in sizes.items():
        parts = n // base
        total = F.lit(0.0)
        for j in range(1, parts):
            total = total + (F.col(f"_m{j}") - F.col("_m"))
        out[name] = F.col("_m") + total / parts
    return df.withColumns(out).drop("_m", *[f"_m{j}" for j in range(1, deepest)])


def wide_moments(df: DataFrame, spec: WindowSpec, value: str, sizes: dict[int, tuple[str, str]], base: int) -> DataFrame:
    """Trailing mean and population variance over wide frames, combined from one narrow frame.

    ``sizes`` maps a frame length (a multiple of ``base``) to its (mean, variance) column
    names. Part means are compared as differences, so a constant series keeps variance 0.
    Values are right where the frame is full.
    """
    narrow = trailing(spec, base)
    df = df.withColumns({"_m0": F.avg(value).over(narrow), "_v0": F.var_pop(value).over(narrow)})
    deepest = max(sizes) // base
    df = df.withColumns({f"_{c}{j}": F.lag(f"_{c}0", base * j).over(spec) for j in range(1, deepest) for c in "mv"})
    for n, (mean, _) in sizes.items():
        parts = n // base
        shift = F.lit(0.0)
        for j in range(1, parts):
            shift = shift + (F.col(f"_m{j}") - F.col("_m0"))
        df = df.withColumn(mean, F.col("_m0") + shift / parts)
    out = {}
    for n, (mean, variance) in sizes.items():
        parts = n // base
        total = F.lit(0.0)
        for j in range(parts):
            gap = F.col(f"_m{j}") - F.col(mean)
            total = total + F.col(f"_v{j}") + gap * gap
        out[variance] = total / parts
    return df.withColumns(out).drop(*[f"_{c}{j}" for j in range(deepest) for c in "mv"])
