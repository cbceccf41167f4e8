import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quaymark import schemas
from quaymark.operators import monitor
from quaymark.sources import readers, sinks


def bodies(spark, *rows):
    return spark.createDataFrame([(s, b if isinstance(b, (str, type(None))) else json.dumps(b)) for s, b in rows], "symbol string, body string")


def bar(close="2.5", **over):
    return {"1. open": "1", "2. high": "3", "3. low": "1", "4. close": close, "5. volume": "10"} | over


def test_series_and_issues(spark):
    key = "Time Series (1min)"
    df = bodies(spark, ("A", {key: {"2024-01-05 09:30:00": bar(), "2024-01-05 09:31:00": bar("x"), "2024-01-05 09:32:00": {}, "bad": bar()}}), ("B", {"Note": "wait"}), ("C", "not json"), ("D", None))
    rows = readers.series(df, key, readers.BAR_FIELDS, "timestamp_ntz")
    clean, issues = readers.split_issues(rows, list(readers.BAR_FIELDS))
    assert [(r.symbol, r.Date, r.Close) for r in clean.collect()] == [("A", dt.datetime(2024, 1, 5, 9, 30), 2.5)]
    assert sorted((r.issue_type, r.detail) for r in issues.collect()) == [("cast_failure", "row 2024-01-05 09:31:00"), ("cast_failure", "row bad"), ("empty_content", "row 2024-01-05 09:32:00")]


def test_body_classes(spark):
    df = bodies(spark, ("a", {"Note": "slow down"}), ("b", {"Information": "this plan is not yet entitled"}), ("c", {"Error Message": "no"}), ("d", {"data": "1"}), ("e", "<html>"))
    assert [r[0] for r in df.orderBy("symbol").select(readers.body_class(F.col("body"))).collect()] == ["av_throttle", "entitlement", "structure_error", None, "structure_error"]


def test_points_keep_sentinels_as_null(spark):
    df = bodies(spark, ("O", {"unit": "usd", "data": [{"date": "2024-01-05", "value": "."}, {"date": "2024-01-04", "value": "7.5"}, {"date": "2024-01-03", "value": "x"}, {"date": "?", "value": "1"}]}))
    assert sorted((r.Date.day, r.value, r.unit) for r in readers.points(df, "value").collect()) == [(4, 7.5, "usd"), (5, None, "usd")]


def test_reports_with_any_columns(spark):
    df = bodies(spark, ("A", {"annualReports": [{"fiscalDateEnding": "2023-12-31-04:00", "reportedCurrency": "USD", "revenue": "5", "debt": "None"}], "quarterlyReports": [{"fiscalDateEnding": "2024-03-31", "other": "1e3"}]}), ("B", {}))
    got = sorted((r.period, r.fiscalDateEnding, r.reportedCurrency, r["values"]) for r in readers.reports(df, "annualReports", "quarterlyReports").collect())
    assert got == [("annual", dt.date(2023, 12, 31), "USD", {"revenue": 5.0}), ("quarterly", dt.date(2024, 3, 31), None, {"other": 1000.0})]


def test_news_explodes_tickers_and_pivots_topics(spark):
    article = {"time_published": "20240105T093000", "title": "t", "url": "u", "authors": [], "topics": [{"topic": "technology", "relevance_score": "0.5"}, {"topic": "technology", "relevance_score": "0.75"}, {"topic": "Else", "relevance_score": "1"}], "ticker_sentiment": [{"ticker": "A", "relevance_score": "0.25"}, {"ticker": "B", "relevance_score": "x"}]}
    late = article | {"time_published": "yesterday"}
    none = article | {"ticker_sentiment": []}
    got = {r.ticker: r for r in readers.news(bodies(spark, (None, {"feed": [article, late, none]}))).collect()}
    assert set(got) == {"A", "B"} and got["A"].technology == 0.75 and got["A"].blockchain is None and got["A"].ticker_relevance_score == 0.25 and got["B"].ticker_relevance_score is None and got["A"].authors == ""


def test_fund_profile(spark):
    p = {"net_assets": "n/a", "sectors": [{"sector": "ENERGY", "weight": "0.25"}, {"sector": "X", "weight": "0.5"}, {"sector": "Y", "weight": "0.125"}, {"sector": "Z", "weight": "?"}], "holdings": [{"symbol": "n/a", "weight": "1"}, {"symbol": "A", "weight": "0.5"}]}
    a, b = readers.fund_profiles(bodies(spark, ("F", p), ("G", {"sectors": [], "holdings": []})), {"ENERGY": "energy"}).orderBy("symbol").collect()
    assert a.energy == 0.25 and a.other == 0.625 and a.net_assets is None and [tuple(h) for h in a.holdings] == [("A", 0.5)]
    assert b.energy is None and b.other is None and b.holdings is None


def test_csv_readers(spark, tmp_path):
    (tmp_path / "active.csv").write_text("symbol,name,exchange,assetType,ipoDate,delistingDate,status\nA,Aa,N,Stock,2020-01-02,null,Active\n")
    (tmp_path / "delisted.csv").write_text("symbol,name,exchange,assetType,ipoDate,delistingDate,status\nA,Aa,N,Stock,bad,2021-01-02,Delisted\n")
    rows = readers.listings(spark, str(tmp_path / "active.csv"), str(tmp_path / "delisted.csv")).orderBy("src_rank").collect()
    assert [(r.src_rank, r.ipoDate, r.delistingDate) for r in rows] == [(0, dt.date(2020, 1, 2), None), (1, None, dt.date(2021, 1, 2))]
    (tmp_path / "BRK%2FB_1min.csv").write_text("timestamp, open, high ,low,close,volume\n2024-01-05 09:30:00,1,2,1,,x\n")
    bar = readers.minute_csv(spark, str(tmp_path / "BRK%2FB_1min.csv")).first()
    assert bar.symbol == "BRK/B" and bar.High == 2.0 and bar.Close is None and bar.Volume is None
    (tmp_path / "v.csv").write_text(" Ticker ,Company Name,Sector\nA,Aa, tech \n")
    v = readers.text_csv(spark, str(tmp_path / "v.csv"))
    assert readers.missing_columns(v, ["Ticker", "IPO Date"]) == ["IPO Date"]
    out = readers.vendor_catalog(v, {"symbol": "Ticker", "name": "Company Name", "sector": "Sector", "ipoDate": "IPO Date"}, {"tech": "Technology"}).first()
    assert out.sector == "Technology" and out.ipoDate is None and out.delistingDate is None
    (tmp_path / "cal.csv").write_text("symbol,name,reportDate,fiscalDateEnding,estimate,currency,timeOfTheDay\nA,n,2024-01-05-04:00,junk,.,USD,\n")
    cal = readers.earnings_calendar(spark, str(tmp_path / "cal.csv")).first()
    assert cal.reportedDate == dt.date(2024, 1, 5) and cal.cast_issues == "fiscalDateEnding"


def test_optional_and_versioned_tables(spark, tmp_path):
    df, there = readers.optional(spark, f"file://{tmp_path}/none", schemas.CATALOG)
    assert not there and df.count() == 0 and df.schema == schemas.CATALOG
    with pytest.raises(FileNotFoundError):
        readers.catalog(spark, f"file://{tmp_path}/none", schemas.CATALOG)
    t = sinks.VersionedTable(spark, f"file://{tmp_path}/v")
    assert t.read() is None
    t.replace(spark.range(3))
    old = t.read()
    t.replace(t.read().filter("id > 0"))  # computed from the version it replaces
    assert t.read().count() == 2 and old.count() == 3


def test_issue_sink_ledger_and_report(spark, tmp_path):
    issues = spark.createDataFrame([], schemas.ISSUES)
    path = f"{tmp_path}/issues"
    sinks.append_issues(issues, path)
    assert not (tmp_path / "issues").exists()
    rows, asked = spark.createDataFrame([("A",), ("A",)], "symbol string"), spark.createDataFrame([("A",), ("B",)], "symbol string")
    led = sinks.ledger(rows, "prices", asked)
    assert sorted((r.symbol, r.n_rows) for r in led.collect()) == [("A", 2), ("B", 0)]
    assert sinks.not_yet_done(spark.createDataFrame([("B",), ("C",)], "symbol string"), led).collect()[0].symbol == "C"
    text, md = sinks.report_text({"x": spark.range(60)})
    assert len(json.loads(text)["x"]) == 50 and "(more than 50 rows)" in md


def test_recovered_months(spark):
    issues = spark.createDataFrame([("A", "structure_error"), ("B", "structure_error"), ("A", "cast_failure")], "symbol string, issue_type string")
    got = readers.drop_recovered(issues, spark.createDataFrame([("A",)], "symbol string"))
    assert sorted(map(tuple, got.collect())) == [("A", "cast_failure"), ("B", "structure_error")]


def test_estimates_and_insider(spark):
    df = bodies(spark, ("A", {"estimates": [{"date": "2024-12-31", "horizon": "fiscal year", "eps": "1.5"}, {"date": "2024-03-31", "horizon": "fiscal quarter", "eps": "None"}, {"date": "2024-03-31", "horizon": "next"}]}))
    assert sorted((r.period, r.fiscalDateEnding.month, r["values"]) for r in readers.estimates(df).collect()) == [("annual", 12, {"eps": 1.5}), ("quarterly", 3, {})]
    df = bodies(spark, ("A", {"data": [{"ticker": "A", "transaction_date": "2024-01-05-04:00", "executive": "X", "executive_title": "", "shares": "5", "price": "?"}]}))
    r = readers.insider_trades(df).first()
    assert r.transactionDate == dt.date(2024, 1, 5) and r.executive == "X" and r.executive_title is None and r["values"] == {"shares": 5.0}


def test_fixed_catalogs(spark):
    assert readers.static_catalog(spark, "commodities").count() == 13 and readers.static_catalog(spark, "economic").count() == readers.indicator_config(spark).count() == 15
    got = readers.with_commodity_class(spark.createDataFrame([("WTI",), ("XAU",), ("CORN",), ("?",)], "symbol string"))
    assert {r.symbol: r["class"] for r in got.collect()} == {"WTI": "daily", "XAU": "gold_silver", "CORN": "monthly", "?": "structure_error"}


def test_index_catalog_and_currency_pairs(spark):
    body = spark.createDataFrame([(json.dumps({"SPX": "S&P 500", "NDX": None}),), ("{}",), ("no json",), (None,)], "body string")
    assert sorted(map(tuple, readers.index_catalog(body).collect())) == [("NDX", None), ("SPX", "S&P 500")]
    codes = spark.createDataFrame([("EUR", "Euro"), ("USD", "United States Dollar"), ("JPY", "Japanese Yen"), (None, "?")], "`currency code` string, `currency name` string")
    assert sorted(map(tuple, readers.currency_pairs(codes).collect())) == [("EURUSD", "Euro to US Dollar"), ("JPYUSD", "Japanese Yen to US Dollar")]


def test_write_by_day_replaces_only_the_days_it_has(spark, tmp_path):
    path, one, two = f"{tmp_path}/news", dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    schema = "symbol string, n int, folder_date date"
    sinks.write_by_day(spark.createDataFrame([("A", 1, one), (None, 2, one), ("A", 3, two)], schema), path)
    sinks.write_by_day(spark.createDataFrame([("B", 4, two)], schema), path)
    got = {(r.symbol, r.n, r.folder_date) for r in spark.read.parquet(path).collect()}
    assert got == {("A", 1, one), (None, 2, one), ("B", 4, two)}


def test_json_reports_say_which_sections_are_cut(spark):
    text, _ = sinks.report_text({"long": spark.range(51), "short": spark.range(50)})
    data = json.loads(text)
    assert len(data["long"]) == len(data["short"]) == 50 and data["cut_sections"] == ["long"]
    assert json.loads(sinks.report_text({"short": spark.range(50)})[0]).keys() == {"short"}
    with pytest.raises(ValueError):
        sinks.report_text({"cut_sections": spark.range(1)})


def test_status_of_every_file(spark, tmp_path):
    folder = tmp_path / "s"
    spark.createDataFrame([("a", 1)], "symbol string, n int").coalesce(1).write.parquet(f"file://{folder}")
    spark.createDataFrame([], "symbol string, n int").coalesce(1).write.mode("append").parquet(f"file://{folder}")
    (folder / "broken.parquet").write_bytes(b"no parquet at all")
    got = readers.file_status(spark, f"file://{folder}/*.parquet", spark.createDataFrame([], "symbol string, n int").schema).collect()
    assert sorted(r.status for r in got) == ["empty", "ok", "unreadable"] and {r.file for r in got if r.status == "unreadable"} == {"broken.parquet"}


def test_daily_csv_headers_and_lookup(spark, tmp_path):
    (tmp_path / "BRK%2FB_day.csv").write_text("Date, Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1.5,10\nx,1,2,0.5,bad,\n")
    got = [tuple(r) for r in readers.daily_csv(spark, f"file://{tmp_path}/*.csv").orderBy(F.col("Date").desc()).collect()]
    assert got == [("BRK/B", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 10.0), ("BRK/B", None, 1.0, 2.0, 0.5, None, None)]
    with pytest.raises(ValueError, match="one: b; two: a, b"):
        readers.check_headers({"one": spark.createDataFrame([(1,)], "a int"), "two": spark.createDataFrame([(1,)], "c int"), "three": spark.createDataFrame([(1, 2)], "a int, b int")}, ["a", "b"])
    files = spark.createDataFrame([("A_day.csv",), ("BRK%2FB_day.csv",)], "file string")
    assert {r.symbol: r.file for r in readers.located(spark.createDataFrame([("A",), ("BRK/B",), ("C",)], "symbol string"), files).collect()} == {"A": "A_day.csv", "BRK/B": "BRK%2FB_day.csv", "C": None}


def test_entitlement_is_told_from_throttling(spark):
    bodies = ['{"Information": "You are not yet entitled to this."}', '{"Note": "Consider a premium plan for more calls."}', '{"Error Message": "x"}', "no json", '{"a": {}}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    assert [r.k for r in df.orderBy("i").select(readers.body_class(df.body).alias("k")).collect()] == ["entitlement", "av_throttle", "structure_error", "structure_error", None]


def test_output_by_symbol_is_resumed_and_moved_aside(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    rows = spark.createDataFrame([("a", "2024-01-02", 1), ("a", "2024-01-01", 2), ("b", "2024-01-01", 3)], "symbol string, Date string, n int")
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string")
    first = sinks.write_by_symbol(rows.filter("symbol = 'a'"), at, asked.filter("symbol <> 'b'"), "prices")
    assert {(r.symbol, r.n_rows) for r in first.collect()} == {("a", 2), ("c", 0)}
    sinks.write_by_symbol(rows, at, asked, "prices")
    assert sorted((r.symbol, r.n) for r in spark.read.parquet(at).collect()) == [("a", 1), ("a", 2), ("b", 3)]
    assert sinks.retire(spark, at) and not sinks.retire(spark, at) and spark.read.parquet(at + ".pre_weekly").count() == 3
    news = spark.createDataFrame([("a", 1), ("z", 2)], "ticker string, n int")
    assert [r.symbol for r in sinks.news_by_symbol(news, asked).collect()] == ["a"]
    (tmp_path / "x.txt").write_text("abc")
    digests = monitor.file_digests(spark, f"file://{tmp_path}/*.txt")
    assert [(r.file, r.bytes, r.md5) for r in digests.collect()] == [("x.txt", 3, "900150983cd24fb0d6963f7d28e17f72")]
