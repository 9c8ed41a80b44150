"""Queries: landed documents, nested payloads, text filters, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import redact as R, text as X
from ..operators import articles as A, holdings as H, nested as N, quality as K, terms as T
from ..sources import landed as L, sinks as S
from . import proxies as P
from .registry import cte, query, r, rlist, rounded, rs

# ------------------------------------------------------------------ scans

@query("scan_bars_range", f"""
SELECT event_type AS symbol, '1Min' AS timeframe, ts AS timestamp, {rs('value')} AS bar_open, {rs('value * 1.5')} AS bar_high, {rs('value * 0.5')} AS bar_low, {rs('value')} AS bar_close,
  CAST(user_id AS DOUBLE) AS bar_volume FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20 12:00:00'""")
def scan_bars_range(spark, d):
    v = F.col("value")
    bars = P.table(spark, d, "events").select(
        F.col("event_type").alias("symbol"), F.lit("1Min").alias("timeframe"), F.col("ts").alias("timestamp"), v.alias("bar_open"), (v * 1.5).alias("bar_high"),
        (v * 0.5).alias("bar_low"), v.alias("bar_close"), F.col("user_id").cast("double").alias("bar_volume"))
    hit = L.scan_bars(bars, "2024-01-05", "2024-01-20 12:00:00")
    return L.ordered(rounded(hit, "bar_open", "bar_high", "bar_low", "bar_close"), "symbol", "timestamp")


REF = ("p_partkey", "symbol", "universe_type", "bar_grain", "note")


@query("scan_reference_csv", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand AS symbol, CASE WHEN p_size % 3 = 0 THEN '' ELSE 'sector_observation_etf' END AS universe_type,
  CASE WHEN p_size % 2 = 0 THEN '1d' ELSE '30m' END AS bar_grain, 'say "' || p_name || '", twice' AS note FROM part""")
def scan_reference_csv(spark, d):
    rows = P.table(spark, d, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("symbol"), F.when(F.col("p_size") % 3 != 0, "sector_observation_etf").alias("universe_type"),
        F.when(F.col("p_size") % 2 == 0, "1d").otherwise(" 30m").alias("bar_grain"), F.concat(F.lit('say "'), "p_name", F.lit('", twice')).alias("note"))
    path = S.write_csv(rows, S.scratch_path(spark, "reference"), REF)
    return L.read_reference_csv(spark, path, REF)


cte("reviewed", """SELECT p_partkey, p_brand AS symbol, CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN 'sector_observation_etf' ELSE 'market_state_etf' END AS universe_type,
  CASE WHEN p_size % 4 = 0 THEN ' ' ELSE '1d' END AS bar_grain FROM part""")


def reviewed(spark, d):
    s = F.col("p_size")
    return P.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("symbol"), F.when(s % 3 == 1, "sector_observation_etf").when(s % 3 == 2, "market_state_etf").alias("universe_type"),
                                            F.when(s % 4 == 0, " ").otherwise("1d").alias("bar_grain"))


@query("universe_filter", "SELECT * FROM reviewed WHERE trim(bar_grain) <> '' AND universe_type = 'sector_observation_etf'")
def universe_filter(spark, d):
    return L.universe_filter(reviewed(spark, d), ("symbol", "bar_grain"), "sector_observation_etf")


@query("symbol_selection", """
SELECT DISTINCT upper(p_brand) AS symbol FROM part WHERE upper(p_brand) IN (SELECT 'BRAND#' || n_nationkey FROM nation WHERE n_regionkey <> 2 UNION SELECT 'BRAND#' || (n_nationkey + 1) FROM nation WHERE n_regionkey <> 2)""")
def symbol_selection(spark, d):
    k = F.col("n_nationkey")
    asked = P.table(spark, d, "nation").where(F.col("n_regionkey") != 2).select(F.concat(F.lit("brand#"), k, F.lit(" , Brand#"), k + 1, F.lit(",")).alias("symbol"))
    return L.select_symbols(P.table(spark, d, "part"), asked, "p_brand")


@query("page_union", f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS t, {rs('o_totalprice')} AS c, i AS n FROM orders, (SELECT unnest([1, 2]) AS i) WHERE o_orderkey % 5 <> 0""")
def page_union(spark, d):
    t = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t")
    one = lambda i: F.struct(t, F.col("o_totalprice").alias("c"), F.lit(i).alias("n"))
    rows = F.when(F.col("o_orderkey") % 5 != 0, F.array(one(1), one(2)))
    pages = P.table(spark, d, "orders").select("o_orderkey", F.to_json(F.struct(rows.alias("bars"), F.lit("x").alias("next_page_token"))).alias("body"))
    out = L.page_union(pages, "bars", "t string, o double, h double, l double, c double, v double, vw double, n bigint", keep=["o_orderkey"])
    return out.select("o_orderkey", "t", r("c").alias("c"), "n")


# ------------------------------------------------------------------ articles

TERMS = ["the ther", "est un", "der sch", "ment"]
PAT = "(the ther|est un|der sch|ment)"
HAY = "lower(concat_ws(' ', coalesce(url, ''), coalesce(themes, ''), coalesce(locations, '')))"
DOMAINS = ("example.org", "blog.")


@query("topic_filter", f"SELECT page_id, regexp_matches(lower(themes), '{PAT}') AS by_tags, regexp_matches(lower(url), '{PAT}') AS by_url, regexp_matches({HAY}, '{PAT}') AS by_all FROM articles")
def topic_filter(spark, d):
    a = P.articles(spark, d)
    return a.select("page_id", A.topic_filter(a, "source_theme_tags_text", TERMS).alias("by_tags"), A.topic_filter(a, "url_only", TERMS).alias("by_url"),
                    A.topic_filter(a, "all_text", TERMS).alias("by_all"))


# one phrase of each document is a list that grows with the tables
PHRASE = "[A-Za-z]{2,} [A-Za-z]{2,}"
PHRASES = f"SELECT DISTINCT lower(regexp_extract(text, '{PHRASE}')) AS term FROM documents"


@query("topic_terms", f"SELECT page_id, term FROM pages JOIN ({PHRASES}) ON term <> '' AND contains(lower(html), term)")
def topic_terms(spark, d):
    terms = P.table(spark, d, "documents").select(F.regexp_extract("text", PHRASE, 0).alias("phrase"))
    return T.term_hits(P.table(spark, d, "pages"), ["page_id"], F.col("html"), terms, "phrase")


@query("topic_filter_listed", f"SELECT page_id, url FROM pages WHERE EXISTS (SELECT 1 FROM ({PHRASES}) WHERE term <> '' AND contains(lower(url || ' ' || html), term))")
def topic_filter_listed(spark, d):
    terms = P.table(spark, d, "documents").select(F.regexp_extract("text", PHRASE, 0).alias("phrase"))
    pages = P.table(spark, d, "pages")
    return T.with_any_term(pages, "page_id", X.haystack(F.col("url"), F.col("html")), terms, "phrase").select("page_id", "url")


MARKET = " OR ".join(f"contains(lower(themes || ' ' || url), '{p}')" for p in X.MARKET_PHRASES)
FOCUS = (f"(contains(lower(locations), 'united states') OR contains(lower(locations), '#us#') OR {MARKET} OR contains(lower(source_domain), 'example.org') "
         "OR contains(lower(url), 'example.org') OR contains(lower(source_domain), 'blog.') OR contains(lower(url), 'blog.'))")


@query("market_focus_filter", f"SELECT page_id, {FOCUS} AS focus FROM articles")
def market_focus_filter(spark, d):
    a = P.articles(spark, d)
    return a.select("page_id", A.market_focus(a, "us_market", DOMAINS).alias("focus"))


@query("partitioned_article_scan", f"""
SELECT page_id, url, article_time FROM articles WHERE partition_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25' AND regexp_matches({HAY}, '{PAT}')
  AND contains(lower(source_domain), 'example') ORDER BY article_time DESC, page_id LIMIT 50""")
def partitioned_article_scan(spark, d):
    out = A.article_scan(P.articles(spark, d), "2024-01-03", "2024-01-25", 50, fields="all_text", terms=TERMS, focus="none", domain_contains="example", tie=["page_id"])
    return out.select("page_id", "url", "article_time")


@query("topk_recent", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 100")
def topk_recent(spark, d):
    return A.topk_recent(P.table(spark, d, "events").select("event_id", "ts", "event_type"), "ts", 100, ["event_id"])


@query("normalize_articles", """
SELECT CASE WHEN page_id % 3 = 0 THEN url ELSE 'g' || page_id END AS article_id,
  CASE page_id % 4 WHEN 0 THEN TIMESTAMP '2024-03-10 00:00:00' + INTERVAL 1 HOUR * (page_id % 48) WHEN 1 THEN TIMESTAMP '2024-07-04' WHEN 2 THEN TIMESTAMP '2024-01-15 12:00:00' END
    AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS seen_at,
  regexp_extract(url, '^https?://([^/?#]+)', 1) AS source_domain, url AS event_link_url, CASE WHEN page_id % 2 = 0 THEN split_part('-1.5,' || page_id, ',', 1) ELSE '' END AS tone,
  'market;sector;industry;theme' AS impact_scope FROM pages WHERE page_id % 7 <> 0""")
def normalize_articles(spark, d):
    k = F.col("page_id")
    hour = F.timestamp_add("HOUR", k % 48, F.lit("2024-03-10").cast("timestamp_ntz"))
    rows = P.table(spark, d, "pages").select(
        F.when(k % 7 != 0, F.concat(F.lit(" "), "url")).alias("url"), F.when(k % 3 != 0, F.concat(F.lit("g"), k)).otherwise("").alias("article_id"),
        F.when(k % 4 == 0, F.date_format(hour, "yyyyMMddHHmmss")).when(k % 4 == 1, "20240704").when(k % 4 == 2, "20240115120000").otherwise("bad").alias("article_date"),
        F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("source_domain"), F.when(k % 2 == 0, F.concat(F.lit("-1.5,"), k)).alias("tone"))
    return A.normalize_articles(rows).select("article_id", "seen_at", "source_domain", "event_link_url", "tone", "impact_scope")


# title of a page stands for the headline of an official filing when the page is one
cte("news", "SELECT page_id, lower(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title, page_id % 3 = 0 AS official FROM pages")


@query("news_covered_by_filing", "SELECT page_id, title FROM news n WHERE NOT official AND NOT EXISTS (SELECT 1 FROM news f WHERE f.official AND f.title = n.title)")
def news_covered_by_filing(spark, d):
    n = P.table(spark, d, "pages").select("page_id", F.lower(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)).alias("title"), (F.col("page_id") % 3 == 0).alias("official"))
    filings = n.where("official").select("title").distinct()
    return n.where(~F.col("official")).join(filings, "title", "left_anti").select("page_id", "title")


@query("normalize_news", """
SELECT doc_id AS id, CASE WHEN n_chars > 500 THEN lang || '-' || source END AS timeline_headline, TIMESTAMP '2024-03-10 04:00:00' + INTERVAL 1 HOUR * (doc_id % 24) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS created_at,
  CASE WHEN doc_id % 2 = 0 THEN [upper(source), upper(lang)] ELSE [] END AS symbols, text AS summary FROM documents""".replace(
    "TIMESTAMP '2024-03-10 04:00:00' + INTERVAL 1 HOUR * (doc_id % 24) AT", "(TIMESTAMP '2024-03-10 04:00:00' + INTERVAL 1 HOUR * (doc_id % 24)) AT"))
def normalize_news(spark, d):
    k = F.col("doc_id")
    at = F.timestamp_add("HOUR", k % 24, F.lit("2024-03-10 04:00:00").cast("timestamp_ntz"))
    rows = P.table(spark, d, "documents").select(
        k.alias("id"), F.when(F.col("n_chars") > 500, F.concat_ws("-", "lang", "source")).alias("headline"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.lit(None).cast("string").alias("updated_at"), F.when(k % 2 == 0, F.array(F.upper("source"), F.upper("lang"))).alias("symbols"), F.col("text").alias("summary"), F.lit("").alias("url"))
    return N.normalize_news(rows).drop("updated_at", "event_link_url")


# ------------------------------------------------------------------ landed documents

# References that occur in these queries' documents; ``&amp;``, also cut short, comes last so nothing is decoded twice.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#8217;", "’"), ("&#x2014;", "—"),
            ("&eacute;", "é"), ("&trade;", "™"), ("&frac12;", "½"), ("&copy;", "©"), ("&middot;", "·"))


def ent(x: str) -> str:
    for e, p in ENTITIES:
        x = f"replace({x}, '{e.replace(chr(39), chr(39) * 2)}', '{p.replace(chr(39), chr(39) * 2)}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def clean_sql(x: str) -> str:
    bare = ent(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')")
    return f"trim(regexp_replace({bare}, '\\s+', ' ', 'g'))"


@query("html_table_rows", f"""
SELECT page_id, row_no, array_to_string(list_transform(regexp_extract_all(li, '(?is)<a\\b[^>]*>(.*?)</a>', 1), lambda x: {clean_sql('x')}), '|') AS cells FROM
(SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1)) AS li, generate_subscripts(regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1), 1) - 1 AS row_no FROM pages)""")
def html_table_rows(spark, d):
    rows = P.table(spark, d, "pages").select("page_id", F.posexplode(L.table_rows(F.col("html"), "li", "a")).alias("row_no", "c"))
    return rows.select("page_id", F.col("row_no").cast("bigint").alias("row_no"), F.array_join("c", "|").alias("cells"))


@query("clean_cell", f"SELECT page_id, {clean_sql(chr(104) + 'tml')} AS text FROM pages")
def clean_cell(spark, d):
    return P.table(spark, d, "pages").select("page_id", X.clean_cell(F.col("html")).alias("text"))


def holding_ids():
    return [F.lit("VGT").alias("etf_symbol"), F.lit("vanguard").alias("issuer_name"), F.concat(F.lit("u"), "p_partkey").alias("source_url"), F.lit("2026-04-24").alias("default_as_of")]


HOLD_SQL = """SELECT 'VGT' AS etf_symbol, 'u' || p_partkey AS source_url, '2026-04-24' AS as_of_date, sym AS holding_symbol, nm AS holding_name, wt AS weight, mv AS market_value FROM part,
  LATERAL (SELECT unnest([{{'sym': 'A' || p_partkey, 'nm': p_name || ', Inc', 'wt': CAST(p_size AS VARCHAR) || '.5', 'mv': '1' || lpad(CAST(p_size AS VARCHAR), 3, '0')}},
    {{'sym': '', 'nm': 'Cash & "Other"', 'wt': '', 'mv': '77'}}], recursive := true))""".replace("{{", "{").replace("}}", "}")


@query("holdings_csv_ingest", HOLD_SQL)
def holdings_csv_ingest(spark, d):
    size = F.col("p_size")
    body = F.concat(
        F.lit("Fund report\nas of, today\n\nTicker,Name,Sector,Weight (%),Market Value\n"),
        F.lit("A"), "p_partkey", F.lit(',"'), "p_name", F.lit(', Inc",Tech,'), size, F.lit('.5%,"$1,'), F.lpad(size.cast("string"), 3, "0"), F.lit('"\n'),
        F.lit(',"Cash & ""Other""",,,$77\n,,,,\n'))
    text = P.landed(spark, d, "part", "p_partkey").select(*holding_ids(), body.alias("text"))
    return L.holdings_csv(text).select("etf_symbol", "source_url", "as_of_date", "holding_symbol", "holding_name", "weight", "market_value")


@query("holdings_json_ingest", HOLD_SQL)
def holdings_json_ingest(spark, d):
    size, k = F.col("p_size"), F.col("p_partkey")
    m = lambda *pairs: F.create_map(*pairs)
    row1 = m(F.lit("ticker"), F.concat(F.lit("A"), k), F.lit("Security Name"), F.concat("p_name", F.lit(", Inc")), F.lit("Weight"), F.concat(size, F.lit(".5%")),
             F.lit("market value"), F.concat(F.lit("$1,"), F.lpad(size.cast("string"), 3, "0")))
    row2 = m(F.lit("ticker"), F.lit(""), F.lit("Security Name"), F.lit('Cash & "Other"'), F.lit("Weight"), F.lit(""), F.lit("market value"), F.lit("77"))
    rows = F.array(row1, row2)
    doc = (F.when(k % 3 == 0, F.to_json(rows)).when(k % 3 == 1, F.to_json(F.struct(rows.alias("holdings"))))
           .otherwise(F.to_json(F.struct(F.struct(rows.alias("rows"), F.lit(1).alias("n")).alias("data"), F.lit("x").alias("fund")))))
    text = P.landed(spark, d, "part", "p_partkey").select(*holding_ids(), doc.alias("text"))
    return L.holdings_json(text).select("etf_symbol", "source_url", "as_of_date", "holding_symbol", "holding_name", "weight", "market_value")


@query("holdings_html_ingest", HOLD_SQL)
def holdings_html_ingest(spark, d):
    size = F.col("p_size")
    cell = lambda *x: F.concat(F.lit("<td class='c'>"), *x, F.lit("</td>"))
    html = F.concat(
        F.lit("<table><tr><td>one</td></tr>\n<tr><th>Ticker</th><th>Holdings</th><th>% of fund</th><th>Market value</th></tr><TR>"),
        cell(F.lit("<b>A"), "p_partkey", F.lit("</b>")), cell("p_name", F.lit(",  Inc")), cell(size, F.lit(".5 %")), cell(F.lit("$1,"), F.lpad(size.cast("string"), 3, "0")),
        F.lit("</TR>\n<tr>"), cell(F.lit("")), cell(F.lit("Cash &amp; &quot;Other&quot;")), cell(F.lit("")), cell(F.lit("77")), F.lit("</tr></table>"))
    text = P.landed(spark, d, "part", "p_partkey").select(*holding_ids(), html.alias("text"))
    return L.holdings_html(text).select("etf_symbol", "source_url", "as_of_date", "holding_symbol", "holding_name", "weight", "market_value")


@query("calendar_parse", """
SELECT 'u' || o_orderkey AS source_url, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 08:30' AS event_time, CASE WHEN o_orderkey % 2 = 0 THEN 'United States' ELSE 'Canada' END AS country,
  'Payrolls & Co ' || o_orderkey AS event, o_orderstatus AS source_event_type, CAST(o_custkey AS VARCHAR) || ' K' AS actual, '' AS previous, '3' AS importance FROM orders""")
def calendar_parse(spark, d):
    k = F.col("o_orderkey")
    td = lambda *x: F.concat(F.lit("<td>"), *x, F.lit("</td>"))
    html = F.concat(
        F.lit("<table><tr><td>x</td></tr><tr><th>Date</th><th>Country</th><th>Event</th><th>Category</th><th>Actual</th><th>Previous</th></tr><tr>"),
        td(F.to_date("o_orderdate").cast("string"), F.lit(" 08:30")), td(F.when(k % 2 == 0, "").otherwise("Canada")), td(F.lit("Payrolls &amp; Co "), k), td("o_orderstatus"), td("o_custkey", F.lit("<i>K</i>")), td(F.lit("")),
        F.lit("</tr><tr><td>Date</td><td>Country</td><td>Event</td><td>x</td></tr><tr><td>a</td><td>b</td></tr></table>"))
    pages = P.landed(spark, d, "orders", "o_orderkey").select(html.alias("html"), F.concat(F.lit("u"), k).alias("source_url"))
    return L.calendar_rows(pages).select("source_url", "event_time", "country", "event", "source_event_type", "actual", "previous", "importance")


# ------------------------------------------------------------------ nested payloads

@query("filings_flatten", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_name AS company_name, 'acc' || c_custkey || '-' || i AS accession_number,
  CASE WHEN i <= 2 THEN '2024-01-0' || i END AS filing_date, CASE WHEN i = 1 THEN '10-K' WHEN i = 2 THEN '8-K' WHEN i = 3 THEN c_mktsegment END AS form
FROM customer, (SELECT unnest([1, 2, 3]) AS i) WHERE c_custkey % 6 <> 0""")
def filings_flatten(spark, d):
    k = F.col("c_custkey")
    ids = F.array(*[F.concat(F.lit("acc"), k, F.lit(f"-{i}")) for i in (1, 2, 3)])
    none = F.array().cast("array<string>")
    recent = F.struct(
        F.when(k % 6 == 0, none).otherwise(ids).alias("accessionNumber"), F.array(F.lit("2024-01-01"), F.lit("2024-01-02")).alias("filingDate"), none.alias("reportDate"),
        F.array(F.lit("10-K"), F.lit("8-K"), F.col("c_mktsegment"), F.lit("extra")).alias("form"), F.lit(None).cast("array<string>").alias("primaryDocument"), none.alias("primaryDocDescription"))
    docs = P.table(spark, d, "customer").select(F.lpad(k.cast("string"), 10, "0").alias("cik"), F.col("c_name").alias("name"), F.struct(recent.alias("recent")).alias("filings"))
    return N.flatten_filings(docs).select("cik", "company_name", "accession_number", "filing_date", "form")


VALUE = "struct<fy: bigint, fp: string, form: string, filed: string, frame: string, `end`: string, val: double, accn: string>"
FACTS = f"map<string, map<string, struct<label: string, description: string, units: map<string, array<{VALUE}>>>>>"


def fact_docs(spark, d):
    k = F.col("c_custkey")
    val = lambda fy, v: F.struct(F.lit(fy).cast("bigint").alias("fy"), F.lit("FY").alias("fp"), F.lit("10-K").alias("form"), F.lit("2024-02-01").alias("filed"), F.lit(None).cast("string").alias("frame"),
                                 F.lit("2023-12-31").alias("end"), v.cast("double").alias("val"), F.concat(F.lit("a"), k).alias("accn"))
    units = F.create_map(F.lit("USD"), F.array(val(2022, F.col("c_acctbal")), val(2023, F.col("c_acctbal") * 2)), F.lit("shares"), F.array(val(2023, k)))
    fact = lambda label: F.struct(F.lit(label).alias("label"), F.lit(None).cast("string").alias("description"), units.alias("units"))
    facts = F.create_map(F.lit("us-gaap"), F.create_map(F.lit("Assets"), fact("Assets"), F.lit("Cash"), fact("Cash")), F.lit("dei"), F.create_map(F.lit("Float"), fact("Float")))
    return P.table(spark, d, "customer").select(k.cast("string").alias("cik"), F.col("c_name").alias("entityName"), facts.cast(FACTS).alias("facts"), units.alias("units"))


FACT_SQL = f"""SELECT CAST(c_custkey AS VARCHAR) AS cik, c_name AS entity_name, tax AS taxonomy, tag, unit, fy, {rs('CASE WHEN unit = $$shares$$ THEN c_custkey WHEN fy = 2022 THEN c_acctbal ELSE c_acctbal * 2 END')} AS value, 'a' || c_custkey AS accession_number
FROM customer, (VALUES ('us-gaap', 'Assets'), ('us-gaap', 'Cash'), ('dei', 'Float')) t(tax, tag), (VALUES ('USD', 2022), ('USD', 2023), ('shares', 2023)) u(unit, fy)"""
FACT_OUT = ("cik", "entity_name", "taxonomy", "tag", "unit", "fy", "value", "accession_number")


@query("facts_explode", FACT_SQL)
def facts_explode(spark, d):
    return rounded(N.flatten_facts(fact_docs(spark, d)), "value").select(*FACT_OUT)


@query("facts_explode_filtered", FACT_SQL + " WHERE tax = 'us-gaap' AND tag = 'Assets' AND unit = 'USD'")
def facts_explode_filtered(spark, d):
    return rounded(N.flatten_facts(fact_docs(spark, d), "us-gaap", "Assets", "USD"), "value").select(*FACT_OUT)


@query("concept_explode", FACT_SQL.replace("tax AS taxonomy, tag", "'us-gaap' AS taxonomy, 'Revenue' AS tag").replace("(VALUES ('us-gaap', 'Assets'), ('us-gaap', 'Cash'), ('dei', 'Float')) t(tax, tag), ", ""))
def concept_explode(spark, d):
    docs = fact_docs(spark, d).withColumns({"label": F.lit(None).cast("string"), "description": F.lit(None).cast("string")})
    return rounded(N.flatten_concept(docs, "us-gaap", "Revenue"), "value").select(*FACT_OUT)


@query("frame_rows", f"SELECT 'us-gaap' AS taxonomy, 'Assets' AS tag, 'USD' AS unit, 'CY2023' AS frame, s_suppkey AS cik, s_name AS entity_name, 'N' || s_nationkey AS loc, {rs('s_acctbal')} AS value FROM supplier")
def frame_rows(spark, d):
    item = F.struct(F.col("s_suppkey").alias("cik"), F.col("s_name").alias("entityName"), F.concat(F.lit("N"), "s_nationkey").alias("loc"), F.lit("2023-12-31").alias("end"), F.col("s_acctbal").alias("val"), F.lit("a").alias("accn"))
    docs = P.table(spark, d, "supplier").select(F.array(item, F.lit(None)).alias("data"))
    out = N.frame_rows(docs, "us-gaap", "Assets", "USD", "CY2023")
    return rounded(out, "value").drop("end", "accession_number")


@query("normalize_equity_bars", f"""
SELECT upper(event_type) AS symbol, CASE event_id % 3 WHEN 0 THEN '1Day' WHEN 1 THEN '30Min' ELSE '5Min' END AS timeframe, date_trunc('second', ts) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS ts,
  {rs('value')} AS bar_open, {rs('value * 2')} AS bar_close, CAST(user_id AS DOUBLE) AS bar_volume, event_id AS bar_trade_count FROM events""")
def normalize_equity_bars(spark, d):
    v, i = F.col("value"), F.col("event_id")
    raw = P.table(spark, d, "events").select(
        F.col("event_type").alias("symbol"), F.when(i % 3 == 0, "1d").when(i % 3 == 1, " 30m").otherwise("5Min").alias("timeframe"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"),
        v.alias("o"), v.alias("h"), v.alias("l"), (v * 2).alias("c"), F.col("user_id").alias("v"), v.alias("vw"), i.alias("n"))
    return rounded(N.normalize_equity_bars(raw), "bar_open", "bar_close").select("symbol", "timeframe", "ts", "bar_open", "bar_close", "bar_volume", "bar_trade_count")


MS_ET = "make_timestamp(CAST(1700000000000 + event_id * 61000 AS BIGINT) * 1000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'"


@query("normalize_crypto_bars", f"SELECT event_id, event_type AS symbol, {MS_ET} AS ts, {rlist('value')}, {rs('value + 1')} AS bar_high, CAST(user_id AS DOUBLE) AS bar_volume FROM events".replace("AS value", "AS bar_open"))
def normalize_crypto_bars(spark, d):
    v = F.col("value")
    ms = F.lit(1700000000000) + F.col("event_id") * 61000
    candle = F.array(*[x.cast("string") for x in (ms, v, v + 1, v - 1, v, F.col("user_id"), F.lit(0), F.lit(0), F.lit(1))])
    raw = P.table(spark, d, "events").select("event_id", F.col("event_type").alias("symbol"), F.lit("1Min").alias("timeframe"), candle.alias("candle"))
    out = N.normalize_candles(raw, keep=["event_id"])
    return rounded(out, "bar_open", "bar_high").select("event_id", "symbol", "ts", "bar_open", "bar_high", "bar_volume")


@query("normalize_crypto_trades", f"""SELECT upper(event_type) AS symbol, {MS_ET} AS ts, CAST(event_id AS VARCHAR) AS trade_id, CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE '' END AS side, {rs('value')} AS price,
  {rs('user_id / 8.0')} AS size, {rs('value * (user_id / 8.0)')} AS notional FROM events""")
def normalize_crypto_trades(spark, d):
    ms = F.lit(1700000000000) + F.col("event_id") * 61000
    raw = P.table(spark, d, "events").select(F.col("event_type").alias("instId"), ms.cast("string").alias("ts"), F.col("event_id").alias("tradeId"), F.when(F.col("user_id") % 2 == 0, "buy").alias("side"),
                                             F.col("value").cast("string").alias("px"), (F.col("user_id") / 8.0).cast("string").alias("sz"))
    return rounded(N.normalize_crypto_trades(raw), "price", "size", "notional").drop("timestamp_utc")


# ------------------------------------------------------------------ holdings

cte("hraw", """SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN '' ELSE ' ' || CASE WHEN p_size % 5 = 0 THEN 'x-1 ' ELSE upper(left(p_name, 3)) || (p_partkey % 100) END END AS holding_symbol,
  p_name || CASE p_size % 7 WHEN 0 THEN ' plc' WHEN 1 THEN ' Cash' WHEN 2 THEN ' S.A. Holdings' ELSE ' Inc' END AS holding_name,
  CASE p_size % 4 WHEN 0 THEN 'Equity' WHEN 1 THEN '' WHEN 2 THEN 'Common Stock' ELSE 'Bond' END AS asset_class,
  CAST(DATE '2024-01-01' + p_size AS VARCHAR) AS as_of_date, upper(p_brand) AS etf_symbol, '$1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.5' AS market_value,
  CASE WHEN p_size % 3 = 0 THEN 'n/a' ELSE p_size || '.25 %' END AS weight FROM part""")
US = f"""(regexp_matches(upper(trim(holding_symbol)), '^[A-Z][A-Z0-9.\\-]{{0,9}}$') AND NOT regexp_matches(asset_class || ' ' || holding_name, '(?i){X.EXCLUDED_ASSET_WORDS}')
  AND NOT regexp_matches(holding_name, '(?i){X.NON_US_WORDS}') AND (asset_class = '' OR regexp_matches(asset_class, '(?i)equity|stock|common')))"""
cte("hreason", f"""SELECT *, CASE WHEN trim(holding_symbol) = '' THEN 'missing_symbol' WHEN as_of_date < '2024-01-05' OR as_of_date > '2024-02-10' THEN 'outside_window'
  WHEN NOT {US} THEN 'non_us_or_non_equity' END AS reason FROM hraw""")
START, END = "2024-01-05", "2024-02-10"


def hraw(spark, d):
    s = F.col("p_size")
    sym = F.when(s % 11 == 0, "").otherwise(F.concat(F.lit(" "), F.when(s % 5 == 0, "x-1 ").otherwise(F.concat(F.upper(F.left("p_name", F.lit(3))), F.col("p_partkey") % 100))))
    end = F.when(s % 7 == 0, " plc").when(s % 7 == 1, " Cash").when(s % 7 == 2, " S.A. Holdings").otherwise(" Inc")
    kind = F.when(s % 4 == 0, "Equity").when(s % 4 == 1, "").when(s % 4 == 2, "Common Stock").otherwise("Bond")
    return P.table(spark, d, "part").select(
        "p_partkey", sym.alias("holding_symbol"), F.concat("p_name", end).alias("holding_name"), kind.alias("asset_class"), F.date_add(F.lit("2024-01-01").cast("date"), s).cast("string").alias("as_of_date"),
        F.col("p_brand").alias("etf_symbol"), F.lit("raw").alias("issuer_name"), F.concat(F.lit("$1,"), F.lpad(s.cast("string"), 3, "0"), F.lit(".5")).alias("market_value"), F.lit("10").alias("shares"),
        F.when(s % 3 == 0, "n/a").otherwise(F.concat(s, F.lit(".25 %"))).alias("weight"), F.lit("Tech").alias("sector_type"))


@query("us_equity_filter", f"SELECT p_partkey, {US} AS us_equity FROM hraw")
def us_equity_filter(spark, d):
    return hraw(spark, d).select("p_partkey", X.is_us_equity(F.col("holding_symbol"), F.col("holding_name"), F.col("asset_class")).alias("us_equity"))


HCLEAN = """SELECT etf_symbol, u.issuer_name, u.universe_type, u.exposure_type, as_of_date, as_of_date || 'T09:30:00-04:00' AS available_time, upper(trim(holding_symbol)) AS holding_symbol, holding_name,
  TRY_CAST(trim(replace(weight, '%', '')) AS DOUBLE) AS weight, CAST(replace(replace(market_value, '$', ''), ',', '') AS DOUBLE) AS market_value FROM hreason JOIN universe u ON u.symbol = etf_symbol WHERE reason IS NULL"""
cte("hclean", HCLEAN)


def hclean(spark, d):
    return H.holdings_clean(hraw(spark, d), P.universe(spark, d), START, END)


@query("holdings_clean", "SELECT * FROM hclean")
def holdings_clean(spark, d):
    return L.ordered(hclean(spark, d).drop("shares", "sector_type"), "etf_symbol", "as_of_date", "holding_symbol")


@query("reject_accounting", "SELECT coalesce(reason, 'kept') AS reason, count(*) AS row_count FROM hreason GROUP BY ALL")
def reject_accounting(spark, d):
    return K.reject_counts(hraw(spark, d).withColumn("reject_reason", H.holding_reason(START, END)))


@query("fund_exposure_by_stock", f"""
SELECT holding_symbol AS symbol, as_of_date, string_agg(DISTINCT etf_symbol, ';' ORDER BY etf_symbol) AS exposed_etfs, arg_max(etf_symbol, row(coalesce(weight, 0), etf_symbol)) AS top_exposure_etf,
  {rs('sum(coalesce(weight, 0))')} AS total_etf_exposure_score, {rs('sum(coalesce(weight, 0) * n / 10.0)')} AS weighted_sector_score, count(DISTINCT etf_symbol) AS source_etf_count
FROM hclean JOIN brands ON symbol = etf_symbol GROUP BY holding_symbol, as_of_date""")
def fund_exposure_by_stock(spark, d):
    scores = P.universe(spark, d).select(F.col("symbol").alias("etf_symbol"), (F.col("n") / 10.0).alias("sector_score"), F.lit(0.0).alias("theme_score"), F.col("exposure_type").alias("tag"))
    out = rounded(H.fund_exposure_by_stock(hclean(spark, d), scores), "total_etf_exposure_score", "weighted_sector_score")
    return out.drop("weighted_theme_score", "exposure_tags", "available_time")


@query("canonical_columns", """
SELECT CAST(p_partkey AS VARCHAR) AS holding_symbol, p_name AS holding_name, p_size AS weight, p_brand AS sector_type, p_retailprice AS market_value, p_type AS cusip FROM part""")
def canonical_columns(spark, d):
    rows = P.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("Ticker"), F.col("p_name").alias("Security Name"), F.col("p_size").alias("% of Net Assets"), F.col("p_brand").alias("Sector"),
                                            F.col("p_retailprice").alias("Market Value ($)"), F.col("p_type").alias("CUSIP "))
    return H.canonical_columns(rows)


@query("normalize_holdings", """
SELECT 'E' || (p_partkey % 9) AS etf_symbol, CASE WHEN p_size % 2 = 0 THEN '2024-02-02' ELSE '2024-01-01' END AS as_of_date, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'T' || p_partkey END AS holding_symbol,
  CASE WHEN p_size % 10 = 0 THEN '' ELSE p_name END AS holding_name, p_size || '.5' AS weight, '1000' AS shares FROM part WHERE p_size % 10 <> 0""")
def normalize_holdings(spark, d):
    s = F.col("p_size")
    rows = P.table(spark, d, "part").select(
        F.concat(F.lit("E"), F.col("p_partkey") % 9).alias("etf_symbol"), F.lit("i").alias("issuer_name"), F.lit("u").alias("source_url"), F.lit("2024-01-01").alias("default_as_of"),
        F.when(s % 2 == 0, "2024-02-02").otherwise(" ").alias("as_of_date"), F.when(s % 5 != 0, F.concat(F.lit(" T"), "p_partkey")).alias("holding_symbol"), F.when(s % 10 != 0, F.col("p_name")).alias("holding_name"),
        F.concat(s, F.lit(".5%")).alias("weight"), F.lit(" 1,000 ").alias("shares"))
    return H.normalize_holdings(rows).select("etf_symbol", "as_of_date", "holding_symbol", "holding_name", "weight", "shares")


# ------------------------------------------------------------------ redaction

@query("redact_columns", """
SELECT doc_id, '[redacted]' AS "user-id", CASE WHEN length(text) > 180 THEN left(text, 180) || '...[truncated]' ELSE text END AS text, string_split(lang || ',a,b,c,d,e,f', ',')[1:5] AS tags,
  '[redacted]' AS inner_token, source AS inner_source FROM documents""")
def redact_columns(spark, d):
    rows = P.table(spark, d, "documents").select("doc_id", F.col("source").alias("user-id"), "text", F.split(F.concat("lang", F.lit(",a,b,c,d,e,f")), ",").alias("tags"),
                                                 F.struct(F.col("lang").alias("access_token"), "source").alias("inner"))
    out = R.redact_columns(rows)
    return out.select("doc_id", "user-id", "text", "tags", F.col("inner.access_token").alias("inner_token"), F.col("inner.source").alias("inner_source"))


@query("redact_url_query", """
SELECT page_id, base || '?api_key=%5Bredacted%5D&file_type=a+b&Key=%5Bredacted%5D&page=' || page_id || '&empty=' || CASE WHEN page_id % 2 = 0 THEN '#top' ELSE '' END AS url
FROM (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS base FROM pages)""")
def redact_url_query(spark, d):
    base = F.regexp_extract("url", "^([^?#]*)", 1)
    url = F.concat(base, F.lit("?api_key=s3cr%26t&file_type=a+b&Key=zzz&page="), "page_id", F.lit("&empty="), F.when(F.col("page_id") % 2 == 0, "#top").otherwise(""))
    return P.table(spark, d, "pages").select("page_id", R.redact_url(url).alias("url"))


@query("redact_page_urls", """
SELECT page_id, CASE WHEN contains(url, '?') THEN regexp_replace(url, '&$', '') ELSE url END AS url FROM pages""")
def redact_page_urls(spark, d):
    return P.table(spark, d, "pages").select("page_id", R.redact_url(F.col("url")).alias("url"))


# ------------------------------------------------------------------ sinks and contracts

LKEYS = ["l_orderkey", "l_linenumber"]
LORD = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query("upsert_keyed", f"""
WITH_CUT SELECT l_orderkey, l_linenumber, {rs('l_quantity')} AS l_quantity, {rs('l_extendedprice')} AS l_extendedprice, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate >= DATE '1999-01-01' DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC) AS rn FROM lineitem) WHERE rn = 1""".replace("WITH_CUT ", ""))
def upsert_keyed(spark, d):
    from ..operators.joins import last_wins

    rows = P.table(spark, d, "lineitem")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    target = last_wins(rows.where(F.col("l_shipdate") < cut), LKEYS, LORD).select(*LKEYS, "l_quantity", "l_extendedprice", "l_returnflag")
    out = S.upsert(target, rows.where(F.col("l_shipdate") >= cut), LKEYS, LORD)
    return rounded(out, "l_quantity", "l_extendedprice")


@query("upsert_versions", f"""
SELECT ship_year, l_orderkey, l_linenumber, {rs('l_quantity')} AS l_quantity, {rs('l_extendedprice')} AS l_extendedprice, l_linestatus FROM (
  SELECT *, year(l_shipdate) AS ship_year, row_number() OVER (PARTITION BY year(l_shipdate), l_orderkey, l_linenumber ORDER BY l_linestatus DESC, {', '.join(c + ' DESC' for c in LORD)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def upsert_versions(spark, d):
    """Lines upserted by ship year in two versions, those with the later status over the others."""
    rows = P.table(spark, d, "lineitem").select(F.year("l_shipdate").alias("ship_year"), *LKEYS, "l_quantity", "l_extendedprice", "l_linestatus", F.struct(*LORD).alias("_order"))
    path = S.scratch_path(spark, "versions")
    for part in (F.col("l_linestatus") == "F", F.col("l_linestatus") != "F"):
        S.upsert_path(spark, path, rows.where(part), ["ship_year", *LKEYS], ["_order"], "ship_year")
    return rounded(S.read_upserted(spark, path), "l_quantity", "l_extendedprice")


@query("table_contract_check", """
SELECT 'not_null:symbol' AS rule, count(*) FILTER (k % 10 = 0) AS violations FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
UNION ALL SELECT 'not_null:timeframe', 0 UNION ALL SELECT 'not_null:timestamp', count(*) FILTER (user_id % 9 = 0) FROM events
UNION ALL SELECT 'unique:symbol,timeframe,timestamp', count(*) FROM (SELECT CASE WHEN k % 10 <> 0 THEN event_type END AS s, CASE WHEN user_id % 9 <> 0 THEN date_trunc('hour', ts) END AS t FROM
  (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY ALL HAVING count(*) > 1)""")
def table_contract_check(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    hour = F.timestamp_add("HOUR", F.hour("ts"), F.to_date("ts").cast("timestamp_ntz"))
    v = F.col("value")
    bars = P.table(spark, d, "events").select(
        F.when(k % 10 != 0, F.col("event_type")).alias("symbol"), F.lit("1Hour").alias("timeframe"), F.when(F.col("user_id") % 9 != 0, hour).alias("timestamp"),
        *[v.alias(c) for c in ("bar_open", "bar_high", "bar_low", "bar_close", "bar_volume", "bar_vwap")], F.lit(1).alias("bar_trade_count"))
    return K.contract_check(bars, "market_bars")


@query("sink_csv_fixed_order", f"SELECT event_id, ts, event_type, {rs('value')} AS value, props FROM events")
def sink_csv_fixed_order(spark, d):
    path = S.write_csv(P.table(spark, d, "events"), S.scratch_path(spark, "csv"), ["event_id", "ts", "event_type", "value", "props"])
    back = spark.read.csv(path, header=True, escape='"', schema="event_id bigint, ts timestamp_ntz, event_type string, value double, props string")
    return rounded(back, "value")


@query("sink_jsonl_cleaned", f"SELECT p_partkey, p_name, {rs('p_retailprice')} AS p_retailprice, CASE WHEN p_size % 2 = 0 THEN p_type END AS p_type FROM part")
def sink_jsonl_cleaned(spark, d):
    rows = P.table(spark, d, "part").withColumn("p_type", F.when(F.col("p_size") % 2 == 0, F.col("p_type")))
    path = S.write_jsonl(rows.select("p_partkey", "p_name", "p_retailprice", "p_type"), S.scratch_path(spark, "jsonl"))
    return rounded(spark.read.json(path, schema="p_partkey bigint, p_name string, p_retailprice double, p_type string"), "p_retailprice")
