"""Joins and windows against brute force, with ties, gaps and hot keys."""

import math
import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tidemark.operators.indicators import daily_indicators, pair_ends, prepare_bars, ratio_tail, close_series, return_corr, return_series
from tidemark.operators.joins import asof_join, interval_join, last_wins, ordered_blocks, visible_rows, with_each
from tidemark.operators.windows import index_rows, rolling, trailing, trailing_z
from tidemark.sources import sinks
from tidemark.sources.sinks import drop_versions, read_upserted, upsert, upsert_path, versions

T0 = datetime(2024, 1, 1)


def test_asof_matches_brute_force(spark):
    rng = random.Random(5)
    right = [("hot" if rng.random() < 0.7 else "cold", T0 + timedelta(hours=rng.randrange(0, 4000)), i, float(i)) for i in range(400)]
    left = [(rng.choice(["hot", "cold", "none"]), T0 + timedelta(hours=rng.randrange(-50, 4100)), i) for i in range(300)]
    r = spark.createDataFrame(right, "k string, rt timestamp_ntz, tie int, v double")
    l = spark.createDataFrame(left, "k string, at timestamp_ntz, id int")
    want = {}
    for k, at, i in left:
        best = [(rt, tie, v) for rk, rt, tie, v in right if rk == k and rt <= at]
        want[i] = max(best)[2] if best else None
    for blocks in (None, 1, 3, 40):
        got = {x.id: x.v for x in asof_join(l, r, ["k"], "at", "rt", ["v"], tie=["tie"], blocks=blocks).collect()}
        assert got == want


@pytest.mark.parametrize("minutes", [390, 1])
def test_asof_of_one_symbol_and_day_spans_several_blocks(spark, minutes):
    """A key-day (and a single minute) with all rows is cut by count; nulls meet nothing, repeated rows stay."""
    rng = random.Random(7)
    at = lambda: T0 + timedelta(minutes=rng.randrange(minutes))
    right = [("hot", at(), i, i if i % 9 else None) for i in range(1500)] + [(None, T0, 1, 5), ("hot", None, 2, 6)]
    left = [("hot", at(), i) for i in range(1500)] + [(None, T0, -1), ("hot", None, -2), ("hot", T0 - timedelta(1), -3), ("hot", T0, 7), ("hot", T0, 7)]
    r = spark.createDataFrame(right, "k string, rt timestamp_ntz, tie int, v int")
    l = spark.createDataFrame(left, "k string, at timestamp_ntz, id int")
    got = asof_join(l, r, ["k"], "at", "rt", ["v"], tie=["tie"], blocks=8).collect()
    last = {}
    for _, t, tie, v in right[:1500]:
        last[t] = max(last.get(t, (-1, None)), (tie, v), key=lambda x: x[0])
    times = sorted(last)
    def hit(k, t):
        best = [x for x in times if x <= t] if k and t else []
        return last[best[-1]][1] if best else None
    assert sorted(map(str, [(x.id, x.v) for x in got])) == sorted(map(str, [(i, hit(k, t)) for k, t, i in left]))
    sizes = [x["count"] for x in ordered_blocks(l, ["k", "at"], 8).where("k = 'hot'").groupBy("_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * len(left) / 8


def test_asof_of_empty_sides(spark):
    l = spark.createDataFrame([("a", T0)], "k string, at timestamp_ntz")
    r = spark.createDataFrame([("a", T0, 1.0)], "k string, rt timestamp_ntz, v double")
    assert [x.v for x in asof_join(l, r.limit(0), ["k"], "at", "rt", ["v"]).collect()] == [None]
    assert asof_join(l.limit(0), r, ["k"], "at", "rt", ["v"]).count() == 0


def test_visible_rows(spark):
    states = spark.createDataFrame([("A", T0 + timedelta(days=d, hours=16), T0 + timedelta(days=d), d) for d in (0, 1, 5)], "symbol string, available_time timestamp_ntz, ts timestamp_ntz, n int")
    marks = [T0 + timedelta(hours=15), T0 + timedelta(hours=16), T0 + timedelta(days=1, hours=15, minutes=59), T0 + timedelta(days=3), T0 + timedelta(days=9)]
    snaps = spark.createDataFrame([(m,) for m in marks], "snapshot_time timestamp_ntz")
    got = {r.snapshot_time: r.n for r in visible_rows(snaps, states).collect()}
    assert got == {marks[1]: 0, marks[2]: 0, marks[3]: 1, marks[4]: 5}


def test_rolling_blocks_equal_plain_windows(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"s{i % 7}", T0 + timedelta(minutes=37 * i), rng.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    spec = Window.partitionBy("k").orderBy("ts")
    cols = lambda w: {"s": F.sum("v").over(trailing(w, 5)), "p": F.lag("v", 3).over(w), "n": F.count("v").over(trailing(w, 4, current=False))}
    want = {(r.k, r.ts): (r.s, r.p, r.n) for r in df.withColumns(cols(spec)).collect()}
    got = {(r.k, r.ts): (r.s, r.p, r.n) for r in rolling(df, ["k"], "ts", ["ts"], 5, cols, chunk="day", block=16).collect()}
    assert got.keys() == want.keys()
    for key, (s, p, n) in want.items():
        assert abs(got[key][0] - s) < 1e-9 and got[key][1:] == (p, n)
    numbered = index_rows(df, ["k"], "ts", ["ts"]).groupBy("k").agg(F.max("rn").alias("m"), F.count("*").alias("c"), F.count_distinct("rn").alias("u")).collect()
    assert all(r.m == r.c == r.u for r in numbered)


def test_trailing_z_skips_nulls_and_excludes_current(spark):
    values = [1.0, None, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([("A", T0 + timedelta(minutes=i), v) for i, v in enumerate(values)], "s string, ts timestamp_ntz, v double")
    got = {r.ts.minute: r.v_z for r in trailing_z(df, ["s"], "ts", ["ts"], ["v"], 4).collect()}
    assert got[4] is None and abs(got[5] - (10 - 2.5) / math.sqrt(1.25)) < 1e-9


def test_interval_keeps_exit_plus_one_hour(spark):
    at = lambda s: datetime.fromisoformat(s)
    rows = spark.createDataFrame([("c", at(f"2026-04-24 {h}")) for h in ("09:29", "09:30", "10:31", "10:32")], "c string, ts timestamp_ntz")
    spans = spark.createDataFrame([("c", at("2026-04-24 09:30"), at("2026-04-24 09:31"))], "c string, lo timestamp_ntz, hi timestamp_ntz")
    got = [r.ts.strftime("%H:%M") for r in interval_join(rows, spans, ["c"], "ts", "lo", "hi", F.make_dt_interval(hours=F.lit(1))).orderBy("ts").collect()]
    assert got == ["09:30", "10:31"]


def test_upsert_last_duplicate_wins(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, seq int")
    assert sorted(map(tuple, upsert(target, batch, ["k"], ["seq"]).collect())) == [(1, "a"), (2, "y"), (3, "z")]
    assert last_wins(batch, ["k"], ["seq"]).count() == 2


UP = "k int, day string, v string, seq int"


def held(df):
    return sorted(((r.k, r.day, r.v) for r in df.collect()), key=str)


def test_upsert_path_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "d1", "a", 0), (2, "d2", "b", 0), (8, None, "n", 0)], UP)
    assert upsert_path(spark, path, first, ["day", "k"], ["seq"], "day") == 1
    files = sorted((tmp_path / "t" / "data").rglob("*.parquet"))
    second = spark.createDataFrame([(2, "d2", "old", 1), (2, "d2", "new", 2), (3, "d2", "c", 1), (9, None, "m", 1)], UP)
    assert upsert_path(spark, path, second, ["day", "k"], ["seq"], "day") == 2
    assert held(read_upserted(spark, path)) == sorted([(1, "d1", "a"), (2, "d2", "new"), (3, "d2", "c"), (8, None, "n"), (9, None, "m")], key=str)
    fresh = set((tmp_path / "t" / "data").rglob("*.parquet")) - set(files)
    assert fresh and all("day=d1" not in str(f) for f in fresh) and all(f.exists() for f in files)
    assert held(read_upserted(spark, path, 1)) == sorted([(1, "d1", "a"), (2, "d2", "b"), (8, None, "n")], key=str)
    assert upsert_path(spark, path, second.limit(0), ["day", "k"], ["seq"], "day") == 3
    assert held(read_upserted(spark, path)) == held(read_upserted(spark, path, 2))


def test_a_writer_that_dies_leaves_the_old_version_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    days = [f"d{i}" for i in range(6)]
    upsert_path(spark, path, spark.createDataFrame([(i, d, "old", 0) for i, d in enumerate(days)], UP), ["day", "k"], ["seq"], "day")
    before = held(read_upserted(spark, path))
    batch = spark.createDataFrame([(i, d, "new", 1) for i, d in enumerate(days)], UP)
    broken = batch.withColumn("v", F.when(F.col("day") == "d4", F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):  # some partitions may be written, none is published
        upsert_path(spark, path, broken, ["day", "k"], ["seq"], "day")
    assert held(read_upserted(spark, path)) == before

    def dies(*_):
        raise OSError("killed")

    with monkeypatch.context() as m:  # all partitions are written, the manifest is not
        m.setattr(sinks, "_publish", dies)
        with pytest.raises(OSError):
            upsert_path(spark, path, batch, ["day", "k"], ["seq"], "day")
    assert held(read_upserted(spark, path)) == before and versions(spark, path) == [1]
    upsert_path(spark, path, batch, ["day", "k"], ["seq"], "day")
    assert held(read_upserted(spark, path)) == [(i, d, "new") for i, d in enumerate(days)]
    assert drop_versions(spark, path, keep=1) == []  # young folders may belong to a writer at work
    assert len(drop_versions(spark, path, keep=1, older_than_hours=0)) >= 2 and versions(spark, path) == [2]
    assert held(read_upserted(spark, path)) == [(i, d, "new") for i, d in enumerate(days)]


def test_second_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = (spark.createDataFrame([(i, "d1", f"w{i}", i)], UP) for i in (1, 2))
    upsert_path(spark, path, one, ["day", "k"], ["seq"], "day")
    with monkeypatch.context() as m:
        real = sinks.upsert

        def late(*args):  # another writer publishes while this one merges
            m.setattr(sinks, "upsert", real)
            upsert_path(spark, path, two, ["day", "k"], ["seq"], "day")
            return real(*args)

        m.setattr(sinks, "upsert", late)
        with pytest.raises(sinks.ConcurrentUpsert):
            upsert_path(spark, path, one, ["day", "k"], ["seq"], "day")
    assert held(read_upserted(spark, path)) == [(1, "d1", "w1"), (2, "d1", "w2")]
    with pytest.raises(ValueError):
        upsert_path(spark, path, one.withColumn("v", F.lit(1)), ["day", "k"], ["seq"], "day")
    with pytest.raises(FileNotFoundError):
        read_upserted(spark, f"{path}-none")


# ------------------------------------------------------------------ indicators against plain Python


def bars_of(spark, series):
    rows = [(s, "1Day", T0 + timedelta(days=d), c, c * 1.02, c * 0.97, c) for s, values in series.items() for d, c in enumerate(values) if c is not None]
    return prepare_bars(spark.createDataFrame(rows, "symbol string, timeframe string, ts timestamp_ntz, bar_open double, bar_high double, bar_low double, bar_close double"))


def pstdev(xs):
    m = sum(xs) / len(xs)
    return math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))


def brute(closes):
    rets = [math.log(b / a) for a, b in zip(closes, closes[1:]) if a > 0 and b > 0]
    vols = [pstdev(rets[i - 20:i]) * math.sqrt(252) for i in range(20, len(rets) + 1)]
    ew = None
    for i, r in enumerate(rets):
        ew = r * r if i == 0 else 0.94 * ew + 0.06 * r * r
    out = {f"realized_vol_{n}d": pstdev(rets[-n:]) * math.sqrt(252) if len(rets) >= n else None for n in (5, 20, 60)}
    out["ewma_vol"] = math.sqrt(ew) * math.sqrt(252) if rets else None
    for n in (20, 50, 200):
        out[f"ma{n}"] = sum(closes[-n:]) / n if len(closes) >= n else None
    full = len(vols) >= 252
    last = vols[-252:]
    out["realized_vol_20d_percentile_252d"] = sum(v <= last[-1] for v in last) / 252 if full else None
    out["realized_vol_20d_zscore_252d"] = (last[-1] - sum(last) / 252) / pstdev(last) if full and pstdev(last) > 0 else None
    return out


def test_indicators_with_invalid_closes(spark):
    rng = random.Random(11)
    series = {"A": [100 + 10 * math.sin(i / 9) + rng.random() for i in range(330)], "B": [50 + rng.random() for _ in range(70)], "FLAT": [7.0] * 300}
    series["A"][40] = -5.0  # two returns become invalid and the series compacts
    series["A"][120] = 0.0
    got = {}
    for r in daily_indicators(bars_of(spark, series)).collect():
        got[(r.symbol, r.idx)] = r
    for s, closes in series.items():
        for n in (1, 2, 6, 21, 41, 42, 61, 70, 121, 122, 200, 280, 300, 330):
            if n > len(closes):
                continue
            for name, want in brute(closes[:n]).items():
                have = got[(s, n)][name]
                if s == "FLAT" and name == "realized_vol_20d_zscore_252d":
                    want = None
                assert (have is None) == (want is None), (s, n, name, have, want)
                assert want is None or abs(have - want) < 1e-9, (s, n, name, have, want)


def test_pairs_align_by_tail_and_short_series_by_front(spark):
    rng = random.Random(2)
    a = [10 + rng.random() for _ in range(90)]
    b = [20 + rng.random() for _ in range(90)]
    b[:55] = [None] * 55  # B lists late: 35 closes, 34 returns
    a[70] = None          # and A misses a day, so dates do not line up
    ind = daily_indicators(bars_of(spark, {"A": a, "B": b}))
    at = T0 + timedelta(days=100)
    snaps = spark.createDataFrame([(at,)], "snapshot_time timestamp_ntz")
    pairs = snaps.withColumns({"numerator": F.lit("A"), "denominator": F.lit("B")})
    ends = pair_ends(visible_rows(snaps, ind), pairs, ["idx", "bad", "ret_idx"])
    ca, cb = [x for x in a if x is not None], [x for x in b if x is not None]
    size = min(len(ca), len(cb))
    want = [x / y for x, y in zip(ca[-size:], cb[-size:])][::-1]
    got = [r.ratio for r in ratio_tail(ends, close_series(ind)).orderBy("k").collect()]
    assert len(got) == size and all(abs(x - y) < 1e-12 for x, y in zip(got, want))
    ra, rb = [[math.log(y / x) for x, y in zip(c, c[1:])] for c in (ca, cb)]

    def corr(w):
        ps = list(zip(ra[-w:], rb[-w:]))
        mx, my = sum(p[0] for p in ps) / len(ps), sum(p[1] for p in ps) / len(ps)
        return sum((x - mx) * (y - my) for x, y in ps) / math.sqrt(sum((x - mx) ** 2 for x, _ in ps) * sum((y - my) ** 2 for _, y in ps))

    row = return_corr(ends, return_series(ind)).first()
    assert abs(row.return_corr_20d - corr(20)) < 1e-9 and abs(row.return_corr_60d - corr(60)) < 1e-9


def test_ratio_tail_reaches_past_non_positive_closes(spark):
    a = [float(i + 1) for i in range(240)]
    a[230] = -1.0
    ind = daily_indicators(bars_of(spark, {"A": a, "B": [2.0] * 240}))
    snaps = spark.createDataFrame([(T0 + timedelta(days=300),)], "snapshot_time timestamp_ntz")
    ends = pair_ends(visible_rows(snaps, ind), snaps.withColumns({"numerator": F.lit("A"), "denominator": F.lit("B")}), ["idx", "bad", "ret_idx"])
    rows = ratio_tail(ends, close_series(ind)).orderBy("k").collect()
    assert len(rows) == 220 and rows[-1].ratio == 20 / 2


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(1, 1000), min_size=3, max_size=12), st.lists(st.floats(1, 1000), min_size=1, max_size=5))
def test_future_bars_never_change_a_past_row(spark, past, future):
    cols = ("return_1d", "realized_vol_5d", "ewma_vol")
    one = {r.idx: tuple(r[c] for c in cols) for r in daily_indicators(bars_of(spark, {"A": past})).collect()}
    two = {r.idx: tuple(r[c] for c in cols) for r in daily_indicators(bars_of(spark, {"A": past + future})).collect()}
    assert all(two[i] == v for i, v in one.items())


def test_lists_of_any_length_meet_every_row(spark):
    from tidemark.operators.joins import pairwise_symbols, with_each

    listed = spark.range(20_000).selectExpr("concat('p', id) AS pair", "id AS n").unionAll(spark.sql("SELECT 'p1' AS pair, 1L AS n"))
    got = with_each(spark.range(3).selectExpr("id AS snapshot"), listed, ["pair", "n"])
    assert got.count() == 60_000 and got.groupBy("snapshot").agg({"n": "sum"}).distinct().count() == 3
    names = spark.range(300).selectExpr("concat('S', lpad(id, 3, '0')) AS symbol")
    pairs = pairwise_symbols(names)
    assert pairs.count() == 300 * 299 // 2 and pairs.where("left_symbol >= right_symbol").count() == 0


def test_lookup_takes_the_last_row_whole(spark):
    from tidemark.operators.joins import lookup

    reviewed = spark.createDataFrame([("A", 2, "new", None), ("A", 1, "old", "z"), ("B", 1, "b", "c")], "symbol string, seq int, issuer string, kind string")
    got = lookup(spark.createDataFrame([("A",), ("C",)], "symbol string"), reviewed, ["symbol"], ["issuer", "kind"], ["seq"]).collect()
    assert sorted(map(tuple, got)) == [("A", "new", None), ("C", None, None)]


def test_interval_join_with_open_ends_and_long_spans(spark):
    import random
    from datetime import datetime, timedelta

    from tidemark.operators.joins import interval_join

    rng, t0 = random.Random(5), datetime(2024, 1, 1)
    at = lambda: t0 + timedelta(hours=rng.randint(0, 2000))
    rows = [(rng.choice("AB"), at(), i) for i in range(200)]
    spans = []
    for i in range(40):
        lo, hi = sorted((at(), at()))
        spans.append((rng.choice("AB"), lo if i % 7 else None, hi if i % 5 else None, i))
    got = interval_join(spark.createDataFrame(rows, "k string, ts timestamp_ntz, r int"), spark.createDataFrame(spans, "k string, lo timestamp_ntz, hi timestamp_ntz, s int"),
                        ["k"], "ts", "lo", "hi", F.make_dt_interval(hours=F.lit(1)))
    want = {(r, s) for k, ts, r in rows for q, lo, hi, s in spans if k == q and (lo is None or ts >= lo) and (hi is None or ts <= hi + timedelta(hours=1))}
    pairs = [(x.r, x.s) for x in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def _plain_trend(num, den):
    """(current, previous, {w: mean}, {w: earlier mean}) of the positive tail-aligned ratios."""
    size = min(len(num), len(den))
    ratio = [a / b for a, b in zip(num[-size:], den[-size:]) if b and a / b > 0] if size else []
    mean = lambda xs, n: sum(xs[-n:]) / n if len(xs) >= n else None
    return ratio, {w: mean(ratio, w) for w in (20, 50, 200)}, {20: mean(ratio[:-5], 20), 50: mean(ratio[:-10], 50), 200: mean(ratio[:-20], 200)}


def test_pair_trend_and_corr_equal_plain_lists(spark):
    from statistics import mean

    from tidemark.operators.indicators import pair_trend

    rng, t0 = random.Random(11), datetime(2020, 1, 1)
    bars, closes = [], {}
    for symbol, skip, bad in (("A", 0.0, 0.0), ("B", 0.1, 0.03), ("C", 0.3, 0.1)):
        price = 50.0
        for day in range(330):
            price *= 1 + rng.uniform(-0.02, 0.02)
            if rng.random() >= skip:
                close = -1.0 if rng.random() < bad else round(price, 4)
                closes.setdefault(symbol, []).append((day, close))
                bars.append((symbol, "1Day", t0 + timedelta(days=day), close, close, close, close))
    df = spark.createDataFrame(bars, "symbol string, timeframe string, ts timestamp_ntz, bar_open double, bar_high double, bar_low double, bar_close double")
    ind = daily_indicators(prepare_bars(df)).persist()
    at = [(t0 + timedelta(days=d, hours=16), a, b) for d in (2, 19, 24, 61, 150, 229, 280, 329) for a, b in (("A", "B"), ("B", "C"), ("C", "A"))]
    pairs = spark.createDataFrame(at, "snapshot_time timestamp_ntz, numerator string, denominator string")
    visible = visible_rows(pairs.select("snapshot_time").distinct(), ind)
    ends = pair_ends(visible, pairs, ["idx", "bad", "ret_idx"]).persist()
    trend = {(r.numerator, r.denominator, r.n_num, r.n_den): r for r in pair_trend(ends, close_series(ind)).collect()}
    corr = {(r.numerator, r.denominator, r.n_num, r.n_den): r for r in return_corr(ends, return_series(ind)).collect()}

    def upto(symbol, when):
        return [c for d, c in closes[symbol] if t0 + timedelta(days=d, hours=16) <= when]

    def returns(xs):
        return [math.log(b / a) for a, b in zip(xs, xs[1:]) if a > 0 and b > 0]

    def plain_corr(x, y, n):
        x, y = x[-n:], y[-n:]
        both = list(zip(x, y))
        if len(both) < 2:
            return None
        mx, my = mean(a for a, _ in both), mean(b for _, b in both)
        sx, sy = sum((a - mx) ** 2 for a, _ in both), sum((b - my) ** 2 for _, b in both)
        return sum((a - mx) * (b - my) for a, b in both) / math.sqrt(sx * sy) if sx > 0 and sy > 0 else None

    close = lambda a, b: a is None and b is None or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-9)
    for when, a, b in at:
        x, y = upto(a, when), upto(b, when)
        ratio, ma, before = _plain_trend(x, y)
        r = trend.get((a, b, len(x), len(y)))
        assert (r is None) == (not ratio)
        if ratio:
            assert close(r.distance_to_ma20, ma[20] and ratio[-1] / ma[20] - 1) and close(r.ma20_ma50_spread, ma[50] and ma[20] / ma[50] - 1)
            for w, lag in ((20, 5), (50, 10), (200, 20)):
                assert close(r[f"ma{w}_slope_{lag}d"], before[w] and ma[w] / before[w] - 1)
            assert close(r.ratio_return_1d, math.log(ratio[-1] / ratio[-2]) if len(ratio) > 1 else None)
        p, q = returns(x), returns(y)
        got = corr.get((a, b, len(p), len(q)))
        if p and q:
            assert close(got.return_corr_20d, plain_corr(p, q, 20)) and close(got.return_corr_60d, plain_corr(p, q, 60))
    ind.unpersist()
    ends.unpersist()


def test_payload_upsert_replaces_a_snapshot(spark, tmp_path):
    from tidemark.plans.features import upsert_payload

    rows = [(datetime(2024, 1, 2, 16), "a"), (datetime(2024, 1, 3, 16), "b")]
    schema = "snapshot_time timestamp_ntz, feature_payload_json string"
    upsert_payload(spark.createDataFrame(rows, schema), f"{tmp_path}/t", ["snapshot_time"])
    upsert_payload(spark.createDataFrame([(rows[1][0], "new"), (datetime(2024, 1, 3, 10), "c")], schema), f"{tmp_path}/t", ["snapshot_time"])
    got = {(r.snapshot_time, r.feature_payload_json) for r in read_upserted(spark, f"{tmp_path}/t").collect()}
    assert got == {rows[0], (rows[1][0], "new"), (datetime(2024, 1, 3, 10), "c")}


def test_open_spans_of_twenty_years_make_few_cells(spark):
    from tidemark.operators.joins import day_number, dyadic_cells

    rng = random.Random(8)
    days = [(a, a + n) for a, n in [(0, 0), (5, 0), (700_000, 7304), (0, (1 << 22) - 1), (737_000, 30)] + [(rng.randint(0, 3_000_000), rng.randint(0, 9000)) for _ in range(200)]]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(days)], "i int, a int, b int").select("i", dyadic_cells(F.col("a"), F.col("b")).alias("c"))
    for r in df.collect():
        a, b = days[r.i]
        covered = sorted((c.cell << c.level, (c.cell + 1 << c.level) - 1) for c in r.c)
        assert covered[0][0] == a and covered[-1][1] == b and all(y[0] == x[1] + 1 for x, y in zip(covered, covered[1:]))
        assert len(r.c) <= max(1, 2 * math.ceil(math.log2(b - a + 2)))
    number = spark.sql("SELECT TIMESTAMP_NTZ'0001-01-01 23:00:00' AS a, TIMESTAMP_NTZ'9999-12-31 00:00:00' AS b").select(day_number(F.col("a")), day_number(F.col("b"))).first()
    assert number[0] == 0 and number[1] < 1 << 22


@pytest.mark.parametrize("few", [0, 8, 10**6])
def test_interval_join_of_few_and_many_spans_a_key(spark, monkeypatch, few):
    """The same rows whichever way a key is joined; spans of 20 years with open ends, turned ones, null keys and times."""
    from tidemark.operators import joins

    monkeypatch.setattr(joins, "FEW_SPANS", few)
    rng = random.Random(12)
    at = lambda: T0 + timedelta(hours=rng.randint(0, 20 * 365 * 24))
    rows = [(rng.choice(["hot", "cold", None]), at() if i % 17 else None, i) for i in range(300)]
    spans = [(rng.choices(["hot", "cold", None], [8, 1, 1])[0], at() if i % 5 else None, at() if i % 3 else None, i) for i in range(60)]
    got = joins.interval_join(spark.createDataFrame(rows, "k string, ts timestamp_ntz, r int"), spark.createDataFrame(spans, "k string, lo timestamp_ntz, hi timestamp_ntz, s int"),
                              ["k"], "ts", "lo", "hi", F.make_dt_interval(hours=F.lit(1)))
    pairs = [(x.r, x.s) for x in got.collect()]
    want = {(r, s) for k, ts, r in rows for q, lo, hi, s in spans
            if k is not None and k == q and ts is not None and (lo is None or ts >= lo) and (hi is None or ts <= hi + timedelta(hours=1))}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
