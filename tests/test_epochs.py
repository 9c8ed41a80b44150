"""Visibility epochs against a look at every snapshot."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.epochs import common_epochs, epochs, expand, merged, pair_epochs, snapshot_grid, with_times
from tidemark.operators.indicators import prepare_bars
from tidemark.plans import features as X

T0 = datetime(2024, 3, 1)
STATE = "symbol string, ts timestamp_ntz, available_time timestamp_ntz, v int"


def half_hours(days):
    return [T0 + timedelta(days=d, minutes=600 + 30 * i) for d in days for i in range(13)]


def snapshots(spark, times):
    return spark.createDataFrame([(t,) for t in times], "snapshot_time timestamp_ntz")


def states(seed, symbols="ABC", days=20):
    """Several states between two snapshots, equal times, nights, weekends and states after the last snapshot."""
    rng, out = random.Random(seed), []
    for s in symbols:
        for k in range(rng.randint(0, 60)):
            at = T0 + timedelta(days=rng.randint(-3, days + 3), minutes=rng.choice([0, 599, 600, 601, 615, 630, 959, 960, 961, 1439]))
            out.append((s, at - timedelta(minutes=rng.randint(0, 3)), at, k))
    return out


def seen_at(rows, symbol, t):
    found = [(a, ts, v) for s, ts, a, v in rows if s == symbol and a <= t]
    return max(found)[2] if found else None


def unique(rows):
    return list({(s, a, ts): (s, ts, a, v) for s, ts, a, v in rows}.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_epochs_equal_a_look_at_every_snapshot(spark, seed):
    rows = unique(states(seed))
    times = half_hours([d for d in range(20) if d % 7 not in (1, 2)])
    grid = snapshot_grid(snapshots(spark, times + times[:5] + [None]))
    assert grid.n == len(times)
    df, listed = spark.createDataFrame(rows, STATE), spark.createDataFrame([("A",), ("B",), ("C",), ("nothing",)], "symbol string")
    spans = epochs(df, grid, ["symbol"], ["v"], listed=listed)
    got = {(r.symbol, r.snapshot_time): r.v for r in expand(spans, grid).collect()}
    assert got == {(s, t): seen_at(rows, s, t) for s in ("A", "B", "C", "nothing") for t in times}
    plain = expand(epochs(df, grid, ["symbol"], ["v"]), grid).collect()
    assert {(r.symbol, r.snapshot_time): r.v for r in plain} == {k: v for k, v in got.items() if v is not None}
    timed = with_times(spans, grid).collect()
    assert sum(r.n_snapshots for r in timed) == len(got) and all(got[r.symbol, r.first_snapshot] == got[r.symbol, r.last_snapshot] == r.v for r in timed)
    assert spans.count() <= len(rows) + 4


def test_pairs_and_common_epochs(spark):
    rows, times = unique(states(9)), half_hours(range(20))
    grid = snapshot_grid(snapshots(spark, times))
    df = spark.createDataFrame(rows, STATE)
    seen = epochs(df, grid, ["symbol"], ["v"])
    listed = [("ab", "A", "B"), ("ca", "C", "A"), ("none", "X", "Y"), ("half", "A", "X")]
    pairs = spark.createDataFrame(listed + listed[:1], "id string, numerator string, denominator string")
    spans = pair_epochs(seen, pairs, ["id", "numerator", "denominator"], ["v"], grid)
    got = {(r.id, r.snapshot_time): (r.num_v, r.den_v) for r in expand(spans, grid).collect()}
    assert got == {(i, t): (seen_at(rows, a, t), seen_at(rows, b, t)) for i, a, b in listed for t in times}
    cut = common_epochs(spans, [])
    assert {(r.id, r.snapshot_time): (r.num_v, r.den_v) for r in expand(cut, grid).collect()} == got
    runs = sorted({(r.first_no, r.last_no) for r in cut.collect()})
    assert runs[0][0] == 0 and runs[-1][1] == len(times) - 1 and all(b[0] == a[1] + 1 for a, b in zip(runs, runs[1:]))
    by_pair = common_epochs(spans, ["id"])
    assert by_pair.count() == spans.count()  # a pair's own spans are its epochs


def test_empty_inputs(spark):
    none, times = snapshots(spark, []), snapshots(spark, half_hours([0]))
    df = spark.createDataFrame(unique(states(4)), STATE)
    listed = spark.createDataFrame([("A",)], "symbol string")
    grid = snapshot_grid(none)
    assert grid.n == 0 and expand(epochs(df, grid, ["symbol"], ["v"], listed=listed), grid).count() == 0
    grid = snapshot_grid(times)
    assert epochs(df.limit(0), grid, ["symbol"], ["v"]).count() == 0
    assert [tuple(r) for r in epochs(df.limit(0), grid, ["symbol"], ["v"], listed=listed).collect()] == [("A", 0, 12, None)]
    spans = merged([(epochs(df.limit(0), grid, ["symbol"], ["v"]), {"v": "w"})], ["symbol"], grid, listed=listed)
    assert [tuple(r) for r in spans.collect()] == [("A", 0, 12, None)]


def bars(spark, days=40):
    """Daily bars of three symbols, one with gaps, and intraday bars of one."""
    rng, out = random.Random(5), []
    for symbol, skip in (("AA", 0.0), ("BB", 0.3), ("CC", 0.1)):
        price = 50.0
        for day in range(days):
            price = round(price * (1 + rng.uniform(-0.03, 0.03)), 2)
            if rng.random() >= skip:
                out.append((symbol, "1Day", T0 + timedelta(days=day), price, price + 1, price - 1, price))
            if symbol == "AA":
                out += [(symbol, "30Min", T0 + timedelta(days=day, minutes=m), price, price, price, price + m / 100) for m in (570, 600, 660, 900)]
    schema = "symbol string, timeframe string, ts timestamp_ntz, bar_open double, bar_high double, bar_low double, bar_close double"
    return prepare_bars(spark.createDataFrame(out, schema))


def reviewed(spark):
    universe = spark.createDataFrame([("AA", "market_state_etf"), ("BB", "market_state_etf"), ("CC", "sector_observation_etf")], "symbol string, universe_type string")
    pairs = spark.createDataFrame([("ab", "primary", "AA", "BB", "30m"), ("ba", "primary", "BB", "AA", "1d"), ("ca", "sector_rotation", "CC", "AA", "30m"), ("cb", "daily_context", "CC", "BB", "1d")],
                                  "combination_id string, combination_type string, numerator string, denominator string, feature_bar_grain string")
    return universe, pairs


def close(a, b):
    return a is None and b is None or a is not None and b is not None and abs(a - b) <= 1e-9 * max(1, abs(a), abs(b))


@pytest.mark.parametrize("plan, keys", [(X.regime_features, ["feature"]), (X.rotation_features, ["rotation_pair_id", "feature"])])
def test_features_at_a_snapshot_are_those_of_the_bars_visible_then(spark, plan, keys):
    """All snapshots in one run, against runs that know one snapshot and no later bar."""
    universe, pairs = reviewed(spark)
    every = half_hours(range(40))
    rows = plan(bars(spark), universe, pairs, snapshots(spark, every)).collect()
    whole = {(r.snapshot_time, *[r[k] for k in keys]): r.value for r in rows}
    names = {k[1:] for k in whole}
    assert len(whole) == len(rows) == len(every) * len(names)
    for t in (every[12], every[13 * 39 + 5]):
        known = bars(spark).where(F.col("available_time") <= F.lit(t))
        alone = {tuple(r[k] for k in keys): r.value for r in plan(known, universe, pairs, snapshots(spark, [t])).collect()}
        assert alone.keys() == names and all(close(v, whole[(t, *n)]) for n, v in alone.items()), t


def test_payload_of_spans_is_the_payload_of_the_rows(spark):
    universe, pairs = reviewed(spark)
    grid = snapshot_grid(snapshots(spark, half_hours(range(0, 40, 13))))
    spans = X.regime_spans(bars(spark), universe, pairs, grid).persist()
    folded = {(r.snapshot_time, r.feature_payload_json) for r in X.fold_spans(spans, [], grid).collect()}
    assert folded == {(r.snapshot_time, r.feature_payload_json) for r in X.fold_payload(expand(spans, grid), ["snapshot_time"]).collect()}
    spans.unpersist()


def test_only_wanted_rotation_features(spark):
    universe, pairs = reviewed(spark)
    at = snapshots(spark, half_hours([30]))
    every = {(r.rotation_pair_id, r.snapshot_time, r.feature): r.value for r in X.rotation_features(bars(spark), universe, pairs, at).collect()}
    for only in (X.SIGNAL_FEATURES, ["relative_strength_return_30m"], ["relative_strength_return_corr_20d", "sector_observation_above_ma20_pct"]):
        some = {(r.rotation_pair_id, r.snapshot_time, r.feature): r.value for r in X.rotation_features(bars(spark), universe, pairs, at, only).collect()}
        assert some == {k: v for k, v in every.items() if k[2] in only}
    with pytest.raises(ValueError):
        X.rotation_features(bars(spark), universe, pairs, at, ["no_such_feature"])
