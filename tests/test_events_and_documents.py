"""Detectors, landed documents, nested payloads, sinks: pinned cases."""

import csv
import html
import io
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.redact import redact_columns, redact_url
from tidemark.functions.text import header_key_text, is_us_equity, unescape
from tidemark.functions.times import iso_et, parse_ts_et
from tidemark.operators.articles import article_scan, normalize_articles
from tidemark.operators.events import detect_equity_events, detect_option_events, equity_measures, event_detail_rows, event_timeline
from tidemark.operators.joins import chain_rows
from tidemark.operators.nested import chain_snapshot, flatten_chain, flatten_facts, option_rows
from tidemark.operators.quality import contract_check, normalize_events, require
from tidemark.plans.features import fold_payload, infer_snapshots
from tidemark.plans.sources import position_bars
from tidemark.sources.landed import calendar_rows, holdings_csv, holdings_html, holdings_json, read_reference_csv
from tidemark.sources.sinks import check_keys, write_csv


def test_equity_event(spark):
    quiet = [41.0, 41.2, 41.1, 41.3, 41.2, 41.4, 41.3, 41.5]
    rows = [("PLUM", "5Min", f"2031-03-03T10:{5 * i:02}:00-05:00", price, price, 300.0 + 7 * i) for i, price in enumerate(quiet)]
    rows.append(("PLUM", "5Min", "2031-03-03T10:40:00-05:00", 47.5, 48.0, 9000.0))
    bars = spark.createDataFrame(rows, "symbol string, timeframe string, t string, bar_open double, bar_close double, bar_volume double").withColumn("ts", parse_ts_et(F.col("t")))
    events = detect_equity_events(bars, lookback_intervals=5).collect()
    assert len(events) == 1
    e = events[0]
    assert e.abnormal_activity_type == "return_zscore;volume_spike;gap" and e.symbol == "PLUM"
    assert e.event_id == "eq_abn_PLUM_20310303_1040000500" and e.relative_strength_zscore == ""
    assert e.summary == "PLUM triggered return_zscore, volume_spike, gap over 5Min bars."


def option_trades(spark):
    rows = [("QZT", "2031-06-20", "PUT", 12.5, "2031-03-03T11:15:07.410", "2031-03-03T11:15:07.395", 1, 0.95, 75, 0.7, 0.95),
            ("QZT", "2031-06-20", "PUT", 12.5, "2031-03-03T11:21:40.002", "2031-03-03T11:21:39.871", 2, 0.8, 55, 0.7, 1.0)]
    df = spark.createDataFrame(rows, "underlying string, expiration string, option_right_type string, strike double, t string, q string, seq int, price double, size int, bid double, ask double")
    return df.withColumns({"ts": parse_ts_et(F.col("t")), "quote_ts": parse_ts_et(F.col("q"))})


def test_option_event(spark):
    standards = {"trade_at_ask": {"max_price_vs_ask": 0.01, "min_ask_touch_ratio": 0.95}, "opening_activity": {"min_window_volume": 120}}
    context = {"standard_id": "s1", "generated_at": "2031-03-03T11:15:08.250000-05:00"}
    ev = detect_option_events(option_trades(spark), standards, "30Min", standard_context=context)
    row = event_timeline(ev).first()
    assert row.id.startswith("opt_evt_") and row.event_link_url == f"{row.id}.csv"
    assert row.timeline_headline == "QZT 2031-06-20 12.5P draws ask-side activity with opening activity"
    assert (row.created_at, row.updated_at) == ("2031-03-03T11:15:07.410000-05:00", context["generated_at"])
    assert (row.symbols, row.summary) == ("QZT;QZT 2031-06-20 12.5P", "trade_at_ask;opening_activity")
    detail = event_detail_rows(ev).first()
    hit = json.loads(detail.triggered_indicators)
    assert set(hit) == {"trade_at_ask", "opening_activity"} and hit["trade_at_ask"]["statistics"]["trade_price"] == 0.95
    assert hit["opening_activity"]["statistics"]["window_volume"] == 130
    assert json.loads(detail.triggering_trade)["trade_size"] == 75 and json.loads(detail.quote_context)["ask"] == 0.95


def test_no_threshold_never_triggers(spark):
    assert detect_option_events(option_trades(spark), {"opening_activity": {}}, "30Min").count() == 0


def test_chain(spark):
    key = "symbol string, expiration string, strike double, option_right_type string, arrival int"
    q = spark.createDataFrame([("QZT", "2031-06-20", 12.5, "PUT", 1, 0.7, 0.95, 31)], key + ", bid double, ask double, bid_size int")
    under = parse_ts_et(F.lit("2031-03-03T16:15:07.395"), "UTC")
    i = spark.createDataFrame([("QZT", "2031-06-20", 12.5, "PUT", 1, 0.41, 12.75)], key + ", implied_vol double, underlying_price double").withColumn("underlying_timestamp", under)
    g = spark.createDataFrame([("QZT", "2031-06-20", 12.5, "PUT", 1, -0.38, 12.8)], key + ", delta double, underlying_price double").withColumn("underlying_timestamp", under)
    snap = parse_ts_et(F.lit("2031-03-03T11:15:08.250000-05:00"))
    rows = chain_rows(q, i, g, snap)
    flat = flatten_chain(chain_snapshot(rows, F.col("symbol"), snap, ["expiration", "strike", "option_right_type"]))
    r = flat.withColumn("at", iso_et(F.col("underlying_timestamp"))).first()
    assert (r.mid, r.spread, r.days_to_expiration, r.delta, r.implied_vol) == (0.825, 0.25, 109, -0.38, 0.41)
    assert r["at"] == "2031-03-03T11:15:07.395000-05:00" and r.option_symbol == "QZT_2031-06-20_P_12.5" and r.underlying_price == 12.8


def test_option_files(spark):
    def file(*rows):
        return json.dumps({"response": [{"contract": dict(zip(("symbol", "expiration", "right", "strike"), key)), "data": data} for key, data in rows]})

    a, b = ("qzt", "2031-05-16", "call", 12.5), ("QZT", "2031-05-16", "PUT", "12.5")
    quotes = file((a, [{"bid": 1.0, "ask": 1.5}, {"bid": 9.0, "ask": 9.5}]), (("", "2031-05-16", "call", 1), [{"bid": 1.0}]), (("QZT", "x", "call", ""), [{"bid": 1.0}]), (b, [{"bid": 2.0}]))
    ivs = file((a, [{"implied_vol": 0.4, "underlying_price": 12.0}]), (b, [{"implied_vol": 0.5, "underlying_price": 12.1}]))
    greeks = file((a, [{"delta": 0.6, "underlying_price": 12.9}]), (b, []))
    df = lambda *bodies: spark.createDataFrame(list(enumerate(bodies)), "seq int, body string")
    under = "underlying_price: double, underlying_timestamp: timestamp_ntz"
    q = option_rows(df(quotes, "{}", None), "bid: double, ask: double", first_only=True)
    assert q.count() == 2
    i = option_rows(df(ivs), f"implied_vol: double, {under}", first_only=True)
    g = option_rows(df(greeks), f"delta: double, {under}", first_only=True)
    rows = {r.option_right_type: r for r in chain_rows(q, i, g, parse_ts_et(F.lit("2031-05-01T09:30:00-04:00"))).collect()}
    assert (rows["CALL"].quote.mid, rows["CALL"].greeks.delta, rows["CALL"].underlying_context.underlying_price) == (1.25, 0.6, 12.9)
    assert rows["PUT"].underlying_context.underlying_price == 12.1 and rows["PUT"].greeks.delta is None and rows["PUT"].quote.mid is None
    seconds = file((a, [{"timestamp": "2031-05-01T09:30:01", "close": 1.0}, {"timestamp": "2031-05-01T09:30:02", "close": 1.1}]), (b, []))
    got = option_rows(df(seconds), "timestamp: string, close: double").orderBy("arrival").collect()
    assert [(r.symbol, r.strike, r.close, r.arrival["_n"]) for r in got] == [("QZT", 12.5, 1.0, 0), ("QZT", 12.5, 1.1, 1)]


def test_position_window(spark):
    t = lambda s: datetime.fromisoformat(f"2031-03-03 {s}")
    contracts = spark.createDataFrame([("QZT", "QZT-P12", "2031-06-20", "PUT", 12, t("13:04"), t("13:20"))],
                                      "underlying string, option_symbol string, expiration string, option_right_type string, strike int, entry_time timestamp_ntz, exit_time timestamp_ntz")
    rows = spark.createDataFrame([("QZT-P12", t(at), close, n) for at, close, n in [("13:03", 0.5, 9), ("13:04", 0.6, 3), ("13:40", 0.7, 4), ("14:20", 0.8, 5), ("14:21", 0.9, 6)]],
                                 "option_symbol string, ts timestamp_ntz, close double, count int")
    out = position_bars(rows, contracts).orderBy("timestamp").collect()
    assert [(r.bar_close, r.bar_trade_count) for r in out] == [(0.6, 3), (0.7, 4), (0.8, 5)] and out[-1].timestamp == t("14:20")


IDS = {"etf_symbol": "ORCH", "issuer_name": "vanguard", "source_url": "u", "default_as_of": "2031-03-03"}


def docs(spark, text):
    return spark.createDataFrame([(text,)], "text string").withColumns({k: F.lit(v) for k, v in IDS.items()})


def test_holdings_html(spark):
    page = """<p>Orchard Growth Fund</p><table><tr><th>Ticker</th><th>Holding</th><th>SEDOL</th><th>% of fund</th><th>Shares</th><th>Market value</th></tr>
      <tr><td>QZT</td><td>Quartz&nbsp;&amp; Tile&trade;</td><td>B0QZT01</td><td>2.75 %</td><td>3,400</td><td>$81,250.5</td></tr></table>"""
    r = holdings_html(docs(spark, page)).first()
    assert (r.holding_name, r.sedol, r.shares, r.as_of_date, r.weight.strip(), r.market_value) == ("Quartz & Tile™", "B0QZT01", "3400", "2031-03-03", "2.75", "81250.5")


CSV_FILES = {
    "preamble": 'Orchard Growth Fund\nas of May\n\nTicker,Company,Weight (%),Shares,Market Value\nQZT,"Quartz, Tile",2.75%,40,"$1,200"\n,,,,\n',
    "quoted line break": 'Ticker,Name,Weight\nQZT,"Quartz\nTile",5\nBRK,"Brick ""Red""",6\n',
    "carriage returns": "Ticker,Name,Weight\rQZT,Quartz,5\r\rBRK,Brick,6\r",
    "stray and open quotes": 'Ticker,Name,Weight\nQZT,6" tile,3\nBRK,Brick,"1\n2',
    "long cell": 'Ticker,Name,Weight\nQZT,"' + "q" * 1_000_000 + '",3\nBRK,b,2',
    "short rows": "Ticker,Name,Weight %,Ticker\nQZT,n,1,TWO\nBRK\n ,\t, 3% ,\n",
    "blank": "",
}


@pytest.mark.parametrize("name", list(CSV_FILES))
def test_holdings_csv_reads_what_a_csv_reader_reads(spark, name):
    text = CSV_FILES[name]
    lines = text.splitlines()
    start = next((i for i, x in enumerate(lines) if "ticker" in x.lower() and "weight" in x.lower()), 0)
    csv.field_size_limit(10_000_000)
    want = []
    for row in csv.DictReader(io.StringIO("\n".join(lines[start:]))):
        cell = {header_key_text(k): (v or "").strip() for k, v in row.items() if k is not None}
        have = (cell.get("ticker", ""), cell.get("name", cell.get("company", "")), cell.get("weight", "").replace("%", "").replace(",", ""))
        want += [have] * bool(have[0] or have[1])
    got = [(r.holding_symbol, r.holding_name, r.weight.strip()) for r in holdings_csv(docs(spark, text)).collect()]
    assert got == [(a, b, c.strip()) for a, b, c in want]


def test_holdings_json_any_depth_and_odd_elements(spark):
    rows = [{"ticker": "QZT", "name": "Quartz", "weight": 0, "shares": 12.50}, 3, None, {"ticker": "BRK", "cusip": False, "sedol": [1]}]
    deep = {"data": {"rows": {"holdings": {"fundHoldings": {"data": {"rows": rows}}}}}}
    for body in (rows, {"data": rows}, deep):
        got = holdings_json(docs(spark, json.dumps(body))).collect()
        assert [(r.holding_symbol, r.holding_name, r.weight, r.shares, r.cusip, r.sedol) for r in got] == [("QZT", "Quartz", "", "12.5", "", ""), ("BRK", "", "", "", "", "[1]")]
    assert holdings_json(docs(spark, "{no json")).count() == 0 and holdings_json(docs(spark, None)).count() == 0


ENTITY_TEXTS = ["caf&eacute; &#8217;x&#x2014; &trade; &frac12;", "&amp;lt; &ampx &notit; &notin; &bogus; &;& a&b", "&#0; &#x110000; &#xD800; &#128; &#129; &#1; &#xfdd0; &#13; &#x1F600;",
                "&#99999999999999999999; &#x000000041; &#0000000000000065;", "&lt;&gt&gt &hellip &NotEqualTilde; &CounterClockwiseContourIntegral;", "&" * 50, "", None]


def test_entities_decode_as_html_says(spark):
    df = spark.createDataFrame([(t,) for t in ENTITY_TEXTS], "t string").select("t", unescape(F.col("t")).alias("u"))
    for r in df.collect():
        assert r.u == (None if r.t is None else html.unescape(r.t))


def test_holding_filter(spark):
    df = spark.createDataFrame([("NVDA", "NVIDIA Corp", "Equity"), ("USD", "US Dollar Cash", "Cash"), ("SAP", "SAP SE", "Equity"), ("A-1.B", "X", "")], "s string, n string, a string")
    assert [r[0] for r in df.select(is_us_equity(F.col("s"), F.col("n"), F.col("a"))).collect()] == [True, False, False, True]


def test_calendar(spark):
    page = """<table><tr><th>Date</th><th>Country</th><th>Event</th><th>Category</th><th>Reference</th><th>Actual</th><th>Previous</th><th>Consensus</th><th>Forecast</th><th>Revised</th></tr>
      <tr><td>2031-02-11 10:15</td><td>Ruritania</td><td>Hop &amp; Malt Index</td><td>Brewing</td><td>Jan</td><td>61.5</td><td>58</td><td>59</td><td>60&frac12;</td><td></td></tr></table>"""
    rows = calendar_rows(spark.createDataFrame([(page, "u"), ("<p>no table</p>", "v")], "html string, source_url string")).collect()
    assert len(rows) == 1 and (rows[0].event, rows[0].country, rows[0].actual, rows[0].consensus, rows[0].te_forecast, rows[0].importance) == (
        "Hop & Malt Index", "Ruritania", "61.5", "59", "60½", "3")


def test_facts_filter(spark, tmp_path):
    body = {"cik": 320193, "entityName": "Apple", "facts": {"us-gaap": {"Assets": {"label": "A", "description": "d", "units": {"USD": [{"fy": 2024, "end": "2024-09-28", "val": 1.0, "accn": "x"}], "EUR": [{"fy": 1}]}}},
                                                           "dei": {"Float": {"label": "F", "units": {"USD": [{"fy": 2}]}}}}}
    from tidemark.catalog.documents import FACTS

    (tmp_path / "f.json").write_text(json.dumps(body))
    df = spark.read.schema(f"cik string, entityName string, facts {FACTS}").json(str(tmp_path / "f.json"))
    assert flatten_facts(df).count() == 3
    row = flatten_facts(df, "us-gaap", "Assets", "USD").collect()
    assert len(row) == 1 and (row[0].cik, row[0].value, row[0].accession_number) == ("320193", 1.0, "x")


def test_article(spark):
    df = spark.createDataFrame([("", "https://x.com/a", "20260427123000", "-1.2,3", "x.com"), ("id", "", "20260427", None, None)], "article_id string, url string, article_date string, tone string, source_domain string")
    rows = normalize_articles(df).withColumn("at", iso_et(F.col("seen_at"))).collect()
    assert len(rows) == 1 and (rows[0].article_id, rows[0]["at"], rows[0].tone) == ("https://x.com/a", "2026-04-27T08:30:00-04:00", "-1.2")
    with pytest.raises(ValueError):
        article_scan(df, "2026-01-02", "2026-01-01")
    with pytest.raises(ValueError):
        article_scan(df, "2026-01-01", "2026-01-02", max_rows=0)


def test_redaction(spark):
    df = spark.createDataFrame([("k", "x" * 300, [1, 2, 3, 4, 5, 6])], "api_key string, note string, items array<int>")
    r = redact_columns(df).first()
    assert r.api_key == "[redacted]" and r.note == "x" * 180 + "...[truncated]" and r["items"] == [1, 2, 3, 4, 5]
    url = "https://a.b/c?api_key=1&registrationkey=2&key=3&file_type=json"
    out = spark.range(1).select(redact_url(F.lit(url))).first()[0]
    assert out.count("%5Bredacted%5D") == 3 and out.endswith("file_type=json")


def test_redaction_reaches_into_maps(spark):
    df = spark.sql("""SELECT map('token', array('SECRET'), 'x', array('y')) AS a, map('x', map('token', 'SECRET', 'k', 'v')) AS b,
      map('m', named_struct('api_key', 'SECRET', 'n', 1), 'password', named_struct('api_key', 'SECRET', 'n', 2)) AS c, array(map('cookie', 7)) AS d""")
    r = redact_columns(df).first()
    assert "SECRET" not in str(r) and r.a == {"token": None, "x": ["y"]} and r.b == {"x": {"token": "[redacted]", "k": "v"}}
    assert r.c["m"]["api_key"] == "[redacted]" and r.c["m"]["n"] == 1 and r.c["password"] is None and r.d == [{"cookie": None}]


def test_bars_of_one_time_are_scored_each(spark):
    start = datetime(2024, 3, 4, 9, 30)
    rows = [("QZT", start + timedelta(minutes=i), i, 10.0, 10.0 + (i % 3) * 0.1, 100.0 + i % 5) for i in range(12)]
    rows += [("QZT", start + timedelta(minutes=12), 12, 10.0, 10.1, 102.0), ("QZT", start + timedelta(minutes=12), 13, 10.0, 40.0, 9000.0)]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, arrival int, bar_open double, bar_close double, bar_volume double")
    got = {r.arrival: r for r in equity_measures(bars, lookback=5).collect()}
    assert len(got) == len(rows)
    volumes = [r[5] for r in rows]
    for i in range(5, len(rows)):
        past = volumes[i - 5 : i]
        mean = sum(past) / 5
        std = (sum((v - mean) ** 2 for v in past) / 5) ** 0.5
        assert got[i].volume_z == pytest.approx((volumes[i] - mean) / std)
    assert abs(got[12].volume_z) < 2 and got[13].volume_z > 1000


def test_event_overview(spark):
    cols = "event_id string, event_time string, available_time string, information_role_type string, event_category_type string, scope_type string, symbol string, title string, source_name string, reference_type string, reference string"
    good = ("e", "2026-04-24T09:35:00-04:00", None, "prior_signal", "macro_data", "macro", None, "t", "s", "web_url", "r")
    out = normalize_events(spark.createDataFrame([good], cols))
    assert out.first().available_time == datetime(2026, 4, 24, 9, 35)
    assert {r.rule: r.violations for r in contract_check(out, "event_overview").collect()}["unique:event_id"] == 0
    bad = spark.createDataFrame([(*good[:3], "rumour", *good[4:])], cols)
    with pytest.raises(Exception, match="information_role_type"):
        normalize_events(bad).collect()
    assert normalize_events(bad, strict=False).first().bad_field == "information_role_type"
    with pytest.raises(Exception, match="title is required"):
        require(spark.createDataFrame([(" ",)], "title string"), ["title"]).collect()


def test_payload_keeps_nulls_sorted(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", None)], "k int, feature string, value double")
    assert fold_payload(df, ["k"]).first().feature_payload_json == '{"a":null,"b":2.0}'
    with pytest.raises(ValueError):
        fold_payload(df, ["missing"])


def test_snapshots(spark):
    t = lambda s: datetime.fromisoformat(f"2024-01-02 {s}")
    df = spark.createDataFrame([("SPY", "30Min", t(x)) for x in ("09:30", "10:00", "15:30", "16:00", "16:30", "10:00:01", "10:15")] + [("SPY", "1Day", t("12:00"))], "symbol string, timeframe string, available_time timestamp_ntz")
    assert sorted(r[0].strftime("%H:%M") for r in infer_snapshots(df).collect()) == ["10:00", "15:30", "16:00"]


def test_csv_round_trip_and_keys(spark, tmp_path):
    df = spark.createDataFrame([(" a ", None, 'say "x", y', "drop")], "s string, n string, q string, extra string")
    path = write_csv(df, str(tmp_path / "c"), ["q", "s", "n"])
    r = read_reference_csv(spark, path, ["q", "s", "n"]).first()
    assert (r.q, r.s, r.n) == ('say "x", y', "a", "")
    for bad in ((["a"], []), ([], ["a"]), (["a"], ["b"]), (["a b"], ["a b"])):
        with pytest.raises(ValueError):
            check_keys(*bad)


@pytest.mark.parametrize("key, parser", [("calendar_parse", "(?is)<tr"), ("holdings_html_ingest", "(?is)<tr"), ("page_union", "from_json"), ("holdings_csv_ingest", r"\\z)")])
def test_documents_are_parsed_once(spark, key, parser):
    """No filter that Spark infers may hold a second copy of the parser."""
    from tidemark.catalog import load

    plan = load()[0][key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert not any(parser in line for line in filters)


def test_null_and_empty_pages_have_no_rows(spark):
    from tidemark.sources.landed import page_union

    pages = spark.createDataFrame([(1, '{"rows": [{"a": 1}, null, {"a": 2}]}'), (2, '{"rows": []}'), (3, None), (4, "no json"), (5, "{}")], "p int, body string")
    assert sorted(page_union(pages, "rows", "a int", keep=["p"]).collect(), key=str) == sorted([(1, 1), (1, None), (1, 2)], key=str)
