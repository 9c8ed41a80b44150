"""Joins of time series: as-of, tail aligned, interval, outer, lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.symbols import right_sort
from ..shared import staged


# --------------------------------------------------------------------------- as-of


def ordered_blocks(rows: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """The rows in blocks (``_part``) of about equal size that follow each other in ``order``; staged.

    Blocks are range partitions, so they are cut by count wherever the rows lie: a key, a day or a single
    moment that holds a third of all rows spans many blocks. A salt ends the order, so equal rows part too.
    They are written once, as the cuts of a range partitioning are sampled anew at each evaluation.
    """
    rows = rows.withColumn("_salt", F.monotonically_increasing_id())
    keys = [*order, "_salt"]
    cut = rows.repartitionByRange(*keys) if blocks is None else rows.repartitionByRange(blocks, *keys)
    return staged(cut.withColumn("_part", F.spark_partition_id()), "blocks")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Backward as-of: each left row gets the last right row with ``right_ts <= left_ts``.

    Right rows with the same time are ordered by ``tie``, then by a hash of their values. Both sides lie in
    one order of (key, time) that is cut into ``blocks`` by count (Spark's shuffle partitions, unless given);
    each block is a window of its own and a table of at most (keys + blocks) rows carries the last value of a key
    into its next blocks. A null key or time meets nothing: such left rows stay, with null values.
    """
    on = list(on)
    tie_key = F.struct(*[F.col(t) for t in tie], F.xxhash64(*values))
    r = right.dropna(subset=[*on, right_ts]).select(
        *on, F.col(right_ts).alias("_ts"), F.lit(1).alias("_side"), tie_key.alias("_tie"), F.struct(*values).alias("_value")
    )
    l = left.select(*on, F.col(left_ts).alias("_ts"), F.lit(2).alias("_side"), F.struct(*left.columns).alias("_left"))
    order = ["_ts", "_side", "_tie"]
    rows = ordered_blocks(r.unionByName(l, allowMissingColumns=True), [*on, *order], blocks)

    in_block = rows.groupBy(*on, "_part").agg(F.max_by("_value", F.when(F.col("_side") == 1, F.struct("_ts", "_tie"))).alias("_value"))
    earlier = Window.partitionBy(*on).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = in_block.withColumn("_value", F.last("_value", ignorenulls=True).over(earlier)).where("_value IS NOT NULL")
    rows = rows.unionByName(carried.withColumn("_side", F.lit(0)), allowMissingColumns=True)

    upto = Window.partitionBy(*on, "_part").orderBy(F.col("_side") > 0, *order, "_salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = F.when(F.col("_ts").isNotNull(), F.last("_value", ignorenulls=True).over(upto))
    return rows.withColumn("_hit", hit).where(F.col("_side") == 2).select("_left.*", *[F.col("_hit")[v].alias(v) for v in values])


def visible_rows(
    snapshots: DataFrame, states: DataFrame, key: str = "symbol", available: str = "available_time", ts: str = "ts"
) -> DataFrame:
    """Rows of ``states`` visible at each snapshot: one per key, the latest available.

    Every state's run of snapshots is found first (see ``epochs``) and spelled out last, so the work before is
    that of the states and the rest the size of the answer.
    """
    from .epochs import epochs, expand, snapshot_grid

    grid = snapshot_grid(snapshots)
    return expand(epochs(states, grid, [key], [c for c in states.columns if c != key], available, ts), grid).select("snapshot_time", *states.columns)


# --------------------------------------------------------------------------- small reviewed lists


def with_each(df: DataFrame, listed: DataFrame, columns: Sequence[str], spread: int = 64) -> DataFrame:
    """Pair each row with each distinct entry of a list.

    The rows are dealt into ``spread`` parts and every part gets the list, by an equi-join on the part, so
    neither the list nor the rows have to fit one task or the driver. Spark sends a short list to the rows.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    entries = listed.select(*columns).distinct().withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))))
    return df.withColumn("_part", part).join(entries, "_part").select(*df.columns, *columns)


def pairwise_symbols(universe: DataFrame, symbol: str = "symbol") -> DataFrame:
    """All unordered pairs of a symbol list, left < right."""
    names = universe.select(F.col(symbol).alias("left_symbol")).distinct()
    listed = names.select(F.col("left_symbol").alias("right_symbol"))
    return with_each(names, listed, ["right_symbol"]).where(F.col("left_symbol") < F.col("right_symbol"))


def lookup(df: DataFrame, reviewed: DataFrame, on: Sequence[str], columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Left join of a reviewed list, one whole row per key: the last by ``order``. Spark broadcasts it by its measured size."""
    return enrich(df, reviewed, on, columns, order)


# --------------------------------------------------------------------------- tail alignment


def tail_align(ends: DataFrame, series: DataFrame, depth: Column) -> DataFrame:
    """Positional alignment of two series from their ends.

    ``ends``: numerator, denominator, n_num, n_den (visible lengths) and whatever ``depth``
    needs; ``series``: symbol, idx (1-based), value. Gives one row per position ``k``
    counted back from the end (0 = last) with both values.
    """
    steps = ends.where(depth > 0).withColumn("k", F.explode(F.sequence(F.lit(0), (depth - 1).cast("int"))))
    num = series.select(
        F.col("symbol").alias("numerator"), F.col("idx").alias("_i"), F.col("value").alias("num_value")
    )
    den = series.select(
        F.col("symbol").alias("denominator"), F.col("idx").alias("_j"), F.col("value").alias("den_value")
    )
    return (
        steps.withColumns({"_i": F.col("n_num") - F.col("k"), "_j": F.col("n_den") - F.col("k")})
        .join(num, ["numerator", "_i"])
        .join(den, ["denominator", "_j"])
        .drop("_i", "_j")
    )


# --------------------------------------------------------------------------- interval, enrich, outer


DAY_ZERO = "0001-01-01"
LEVELS = 22  # 2^22 days hold every date from year 1 to 9999
FEW_SPANS = 8


def day_number(day: Column) -> Column:
    return F.datediff(F.to_date(day), F.lit(DAY_ZERO).cast("date"))


def dyadic_cells(first: Column, last: Column) -> Column:
    """The fewest aligned cells of 2^level days that make up ``first`` to ``last`` (day numbers): array of (level, cell).

    At most two of each level, so a span of n days has at most 2 log2(n) cells, however long it is.
    """
    levels = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: F.struct(
        k.alias("level"), F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1), k) - 1, k).alias("a"),
        (F.call_function("shiftright", last + 1, k) - 1).alias("b")))

    def ends(x: Column) -> Column:
        pick = lambda keep, cell: F.when(keep, F.struct(x["level"].alias("level"), cell.alias("cell")))
        return F.array_compact(F.array(pick(x["a"] % 2 == 1, x["a"]), pick(x["b"] % 2 == 0, x["b"])))

    return F.flatten(F.transform(F.filter(levels, lambda x: x["a"] <= x["b"]), ends))


def interval_join(
    rows: DataFrame, spans: DataFrame, on: Sequence[str], ts: str, lo: str, hi: str, slack: Column | None = None
) -> DataFrame:
    """Rows inside their span ``lo <= ts <= hi (+ slack)``; an open end does not clip. Rows without a time are in no span.

    A key with at most FEW_SPANS spans is joined on itself: each of its rows meets so many spans, and rows are shuffled once. Of a key
    with more (looked up first, written once), spans are cut into aligned cells of 1, 2, 4, ... days and each row looks into the cell of
    every size that its day lies in, so a span of n days is 2 log2 n rows, open ends included, and a row meets hardly more spans than hold it.
    """
    end = F.col(hi) if slack is None else F.col(hi) + slack
    first = F.coalesce(day_number(F.col(lo)), F.lit(0))
    last = F.coalesce(day_number(end), F.lit((1 << LEVELS) - 1))
    on, timed = list(on), rows.where(F.col(ts).isNotNull())
    inside = (F.col(lo).isNull() | (F.col(ts) >= F.col(lo))) & (F.col(hi).isNull() | (F.col(ts) <= end))
    numbered = spans.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    many = staged(numbered.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW_SPANS).select(*on), "many")
    if many.isEmpty():
        return timed.join(numbered.drop("_first", "_last"), on).where(inside)
    of_few = timed.join(many, on, "left_anti").join(numbered.drop("_first", "_last").join(many, on, "left_anti"), on)
    as_cells = lambda level, cell: F.struct(level.alias("level"), cell.alias("cell"))
    cut = numbered.join(many, on, "left_semi").withColumn("_c", F.explode(dyadic_cells(F.col("_first"), F.col("_last"))))
    cut = cut.withColumns({"_level": "_c.level", "_cell": "_c.cell"}).drop("_first", "_last", "_c")
    probe = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: as_cells(k, F.call_function("shiftright", day_number(F.col(ts)), k)))
    asked = timed.join(many, on, "left_semi").withColumn("_c", F.explode(probe)).withColumns({"_level": "_c.level", "_cell": "_c.cell"}).drop("_c")
    of_many = asked.join(cut, [*on, "_level", "_cell"]).drop("_level", "_cell")
    return of_few.unionByName(of_many).where(inside)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``. Combined map-side, so many copies of one key are no skew."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_row")
    return df.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def enrich(df: DataFrame, extra: DataFrame, on: Sequence[str], columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Left equi-join of extra columns; among duplicates on the key the last wins."""
    keep = [*on, *columns]
    one = last_wins(extra.select(*dict.fromkeys([*keep, *order])), list(on), list(order or columns)).select(*keep)
    return df.join(one, list(on), "left")


def full_outer_coalesce(
    a: DataFrame, b: DataFrame, on: Sequence[str], prefer: Sequence[str] = (), defaults: dict[str, Column] | None = None
) -> DataFrame:
    """FULL OUTER join; columns in both sides take ``a``'s value first, then ``b``'s, then a default."""
    defaults = defaults or {}
    both = list(prefer) or [c for c in a.columns if c in b.columns and c not in on]
    la, lb = a.alias("a"), b.alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in on]
    out = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in on]
    for name in dict.fromkeys([*a.columns, *b.columns]):
        if name in on:
            continue
        if name in both:
            parts = [F.col(f"a.{name}"), F.col(f"b.{name}")]
        else:
            parts = [F.col(f"a.{name}" if name in a.columns else f"b.{name}")]
        if name in defaults:
            parts.append(defaults[name])
        out.append(F.coalesce(*parts).alias(name) if len(parts) > 1 else parts[0].alias(name))
    return la.join(lb, cond, "full_outer").select(*out)


def bars_with_liquidity(bars: DataFrame, liquidity: DataFrame, on: Sequence[str] = ("symbol", "bucket")) -> DataFrame:
    """Provider bars FULL OUTER liquidity bars; the provider's fields win, liquidity-only rows stay."""
    joined = full_outer_coalesce(bars, liquidity, list(on))
    return joined.withColumns(
        {
            "dollar_volume": F.col("bar_close") * F.col("bar_volume"),
            "spread_bps": F.try_divide(F.col("avg_spread"), F.col("avg_mid")) * 10000,
        }
    )


CHAIN_KEY = ("symbol", "expiration", "strike", "option_right_type")


def chain_rows(quotes: DataFrame, ivs: DataFrame, greeks: DataFrame, snapshot: Column) -> DataFrame:
    """Quotes, implied volatilities and Greeks FULL OUTER on the contract.

    Each input: contract key, ``arrival`` and its own value columns. The last arrival wins;
    the underlying comes from the Greeks row, else the IV row; expired contracts drop. A Greeks row
    with ``has_data`` false (see ``nested.option_rows``) counts as none.
    """
    plain = (*CHAIN_KEY, "arrival", "has_data")

    def one(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
        key_ok = F.lit(True)
        for k in CHAIN_KEY:
            key_ok = key_ok & F.col(k).isNotNull()
        body = df.where(key_ok).withColumns(
            {"symbol": F.upper("symbol"), "option_right_type": F.upper("option_right_type")}
        )
        return (
            body.groupBy(*CHAIN_KEY)
            .agg(F.max_by(F.struct(*columns), F.col("arrival")).alias(name))
        )

    q = one(quotes, "q", [c for c in quotes.columns if c not in plain])
    i = one(ivs, "i", [c for c in ivs.columns if c not in plain])
    g = one(greeks, "g", [c for c in greeks.columns if c not in (*CHAIN_KEY, "arrival")])
    from_greeks = F.col("g").isNotNull() & (F.coalesce(F.col("g.has_data"), F.lit(False)) if "has_data" in greeks.columns else F.lit(True))
    joined = q.join(i, list(CHAIN_KEY), "full_outer").join(g, list(CHAIN_KEY), "full_outer")
    dte = F.datediff(F.col("expiration").try_cast("date"), F.to_date(snapshot)).cast("bigint")
    under = F.when(from_greeks, F.struct(F.col("g.underlying_price"), F.col("g.underlying_timestamp"))).otherwise(
        F.struct(F.col("i.underlying_price"), F.col("i.underlying_timestamp"))
    )
    quote_fields = [F.col(f"q.{c}").alias(c) for c in quotes.columns if c not in (*plain, "bid", "ask")]
    quote = F.struct(
        F.col("q.bid").alias("bid"),
        F.col("q.ask").alias("ask"),
        ((F.col("q.bid") + F.col("q.ask")) / 2).alias("mid"),
        (F.col("q.ask") - F.col("q.bid")).alias("spread"),
        F.try_divide(F.col("q.ask") - F.col("q.bid"), (F.col("q.bid") + F.col("q.ask")) / 2).alias("spread_pct"),
        *quote_fields,
    )
    iv_fields = [F.col(f"i.{c}").alias(c) for c in ivs.columns if c in ("implied_vol", "iv_error")]
    greek_fields = [F.col(f"g.{c}").alias(c) for c in greeks.columns if c in ("delta", "theta", "vega", "rho", "epsilon", "lambda")]
    return joined.where(dte.isNull() | (dte >= 0)).select(
        *CHAIN_KEY,
        quote.alias("quote"),
        F.struct(*iv_fields).alias("iv"),
        F.struct(*greek_fields).alias("greeks"),
        F.struct(dte.alias("days_to_expiration")).alias("derived"),
        under.alias("underlying_context"),
        F.col("q").isNull().alias("quote_missing"),
    )


def chain_order(df: DataFrame) -> DataFrame:
    return df.orderBy("expiration", "strike", right_sort(F.col("option_right_type")), "symbol")
