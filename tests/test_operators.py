import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quaymark.functions import expr
from quaymark.operators import catalog, clean, coverage, monitor, prices, windows
from quaymark.plans import reference

D = dt.date


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


def test_half_open_edges_and_floor(spark):
    days = spark.createDataFrame([(D(2026, 4, d),) for d in range(9, 19)], "d date")
    got = lambda p, f: [r.d.day for r in days.filter(windows.half_open(F.col("d"), p, f)).orderBy("d").collect()]
    prev, folder = F.lit(D(2026, 4, 14)), F.lit(D(2026, 4, 17))
    assert got(prev, folder) == [15, 16, 17]
    assert got(windows.with_floor(prev, folder), folder) == [11, 12, 13, 14, 15, 16, 17]
    assert got(folder, folder) == []


@pytest.mark.parametrize("day,years,want", [(D(2024, 2, 29), 1, D(2023, 2, 28)), (D(2024, 2, 29), 4, D(2020, 2, 29)), (D(2023, 3, 1), 5, D(2018, 3, 1))])
def test_years_before(spark, day, years, want):
    assert one(spark, expr.years_before("d", years), d=day) == want


@pytest.mark.parametrize("at,want", [((2024, 1, 5, 19, 59), D(2024, 1, 4)), ((2024, 1, 5, 20, 0), D(2024, 1, 5)), ((2024, 1, 6, 1, 0), D(2024, 1, 6)), ((2024, 1, 8, 9, 0), D(2024, 1, 7))])
def test_trading_date(spark, at, want):
    assert one(spark, expr.trading_date(F.col("t")), t=dt.datetime(*at)) == want


def test_month_sequence_guards(spark):
    seq = lambda a, b: one(spark, expr.month_sequence(F.col("a"), F.col("b")), a=a, b=b)
    assert seq(D(2024, 1, 31), D(2024, 3, 1)) == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]
    assert seq(D(2024, 3, 1), D(2024, 1, 31)) == []


@pytest.mark.parametrize("text,want", [("1.5", 1.5), (" 2 ", 2.0), ("1_000", None), ("1d", None), ("nan", None), ("", None), (".", None), ("1e3", 1000.0), ("x", None)])
def test_numbers(spark, text, want):
    assert one(spark, expr.number("x"), x=text) == want


def test_dates_names_and_lists(spark):
    assert one(spark, expr.lax_date("x"), x="2024-01-05-04:00\n") == D(2024, 1, 5) and one(spark, expr.lax_date("x"), x="2024-13-05") is None
    assert one(spark, expr.news_stamp("x"), x="20240105T1200") is None
    for symbol in ("BRK/B", "A B*~", "50%_x", "ß.é+1"):
        assert one(spark, expr.symbol_of_file(F.concat(F.lit("stocks_"), expr.safe_file_name("x"), F.lit("_annual.parquet"))), x=symbol) == symbol
    assert one(spark, expr.issue_list([("a", F.lit(True)), ("b", F.lit(None).cast("boolean")), ("c", F.lit(True))]), x=1) == "a,c"
    assert one(spark, expr.issue_list([("a", F.lit(False))]), x=1) is None


def test_corporate_actions_round_trip(spark):
    # made the other way round: adjust by all later splits, then find them again
    rng = random.Random(4)
    rows = [("ABC"[k], D(2024, 1, 1) + dt.timedelta(days=i), 50 + rng.random() * 10, rng.choice([1.0] * 8 + [2.0, 0.5, 4.0])) for k in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, Date date, Close double, SplitCoefficient double")
    adjusted = prices.split_adjust(df)
    flat = adjusted.select("symbol", "Date", F.col("sa_close").alias("Close"))
    got = {(r.symbol, r.Date): (r.SplitCoefficient, r.DividendAmount) for r in prices.corporate_actions(df.select("symbol", "Date", "Close"), flat, flat).collect()}
    for s, day, _, split in rows:
        assert got[s, day] == ((1.0 if day == D(2024, 1, 1) else split), 0.0)


def test_dividend_and_null_close(spark):
    day = [D(2024, 1, d) for d in (1, 2, 3, 4)]
    make = lambda *c: spark.createDataFrame([("A", d, x) for d, x in zip(day, c)], "symbol string, Date date, Close double")
    got = prices.corporate_actions(make(10.0, 10.0, None, 10.0), make(10.0, 10.0, 10.0, 0.0), make(9.5, 10.0, 10.0, 10.0)).orderBy("Date").collect()
    assert [(r.SplitCoefficient, r.DividendAmount) for r in got] == [(1.0, 0.0), (1.0, 0.5), (1.0, 0.0), (1.0, 0.0)]


def test_listing_merge_rules(spark):
    today = D(2024, 3, 1)
    s = "symbol string, ipo date, delisting date, status string"
    old = spark.createDataFrame([
        ("same", D(2020, 1, 1), None, "Active"), ("gone", None, None, "Active"), ("moved", None, None, "Active"), ("old", None, D(2024, 1, 1), "Corrupted"),
        ("young", None, D(2024, 2, 20), "Corrupted"), ("dead", None, D(2020, 1, 1), "Delisted"), ("back", None, D(2024, 2, 1), "Corrupted"), ("ends", None, None, "Active"), ("odd", None, None, None),
    ], s)
    fresh = spark.createDataFrame([("same", D(2019, 1, 1), None, "Active"), ("back", None, None, "Active"), ("ends", None, D(2024, 2, 28), "Delisted"), ("odd", None, None, "Delisted"), ("new", D(2024, 1, 1), None, "Active")], s)
    other = spark.createDataFrame([("moved",)], "symbol string")
    got = {r.symbol: (r.ipo, r.delisting, r.status) for r in catalog.merge_listing(old, fresh, other, F.lit(today)).collect()}
    assert got == {
        "same": (D(2019, 1, 1), None, "Active"), "gone": (None, today, "Corrupted"), "moved": (None, today, "Delisted"), "old": (None, D(2024, 1, 1), "Delisted"),
        "young": (None, D(2024, 2, 20), "Corrupted"), "dead": (None, D(2020, 1, 1), "Delisted"), "back": (None, None, "Active"), "ends": (None, D(2024, 2, 28), "Delisted"),
        "odd": (None, None, None), "new": (D(2024, 1, 1), None, "Active"),
    }


def test_matrix_rules(spark):
    symbols = spark.createDataFrame([("A", "stocks"), ("B", "stocks"), ("F", "etfs")], "symbol string, asset_type string")
    issues = spark.createDataFrame([("A", "p", "structure_error"), ("A", "q", "empty_content"), ("B", "q", "empty_content"), ("B", "p", "cast_failure"), ("F", "p", "timezone_mismatch")], "symbol string, endpoint string, issue_type string")
    ledger = spark.createDataFrame([("B", "q")], "symbol string, endpoint string")
    m = coverage.finalise_matrix(symbols, issues, ledger, {"stocks": ("p", "q"), "etfs": ("p",)}, ("p", "q"), forgiving=("q",))
    assert {r.symbol: (r.p, r.q) for r in m.collect()} == {"A": (False, False), "B": (True, True), "F": (True, None)}
    assert {(r.endpoint, r.n_true, r.n_false, r.n_null, r.true_ratio) for r in coverage.rollup_matrix(m, ("p", "q")).collect()} == {("p", 2, 1, 0, 0.6667), ("q", 1, 1, 1, 0.5)}
    assert coverage.rollup_matrix(m.limit(0), ("p",)).first().true_ratio == 0.0
    assert sorted(r.symbol for r in clean.known_empty(m, "q").collect()) == ["A"]


def test_report_merge(spark):
    s = "symbol string, asset_type string, endpoint string"
    report = spark.createDataFrame([("A", "stocks", "p"), ("A", "stocks", "p"), (None, "stocks", "p"), ("B", "stocks", "p")], s)
    got = coverage.merge_report(report, spark.createDataFrame([("A", "stocks", "p"), (None, "stocks", "p")], s), spark.createDataFrame([("C", "stocks", "p")], s))
    assert sorted(str(r.symbol) for r in got.collect()) == ["B", "C", "None"]


def test_probe_and_diff(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, None), ("B", 1, 1.0)], "symbol string, Date int, Close double")
    got = {r.symbol: (r.n_rows, r.reasons, r.ok) for r in monitor.probe(df, "symbol", "Date", ["Close"], 2).collect()}
    assert got == {"A": (2, "Close has nulls", False), "B": (1, "rows below 2", False)}
    p, c = (spark.createDataFrame(x, "m string, v long") for x in ([("a", 5), ("b", 1)], [("a", 3), ("c", 2)]))
    assert {r.m: r.delta for r in monitor.metric_diff(p, c, "m", "v").collect()} == {"a": -2, "b": None, "c": None}


def test_cleaning_names_what_it_loses(spark):
    df = spark.createDataFrame([("A", "1", "x"), ("A", "bad", "2"), ("B", "None", ".")], "symbol string, p string, q string")
    rows, issues = clean.cast_columns(df, "symbol", ["p", "q"])
    assert sorted((r.symbol, str(r.p), str(r.q)) for r in rows.collect()) == [("A", "1.0", "None"), ("A", "None", "2.0"), ("B", "None", "None")]
    assert sorted((r.symbol, r.detail, r.n) for r in issues.collect()) == [("A", "p", 1), ("A", "q", 1)]
    assert sorted((r.symbol, r.detail) for r in clean.null_issues(rows, "symbol", ["p", "q"]).collect()) == [("A", "2 null values"), ("B", "2 null values")]
    m = spark.createDataFrame([(1, {"1. Information": "x", "6. Time Zone": "UTC"}), (2, {"6. Time Zone": "US/Eastern"}), (3, None), (4, {})], "id int, m map<string,string>")
    assert [r[0] for r in m.orderBy("id").select(clean.time_zone_issue(F.col("m"), "US/Eastern")).collect()] == ["timezone_mismatch", None, "structure_error", None]
    assert [r[0] for r in m.orderBy("id").select(clean.missing_keys(F.col("m"), ["1. Information", "z"])).collect()] == ["z", "1. Information;z", "1. Information;z", "1. Information;z"]


def test_point_in_time_and_restatements(spark):
    df = spark.createDataFrame([("A", 1, 10.0), ("A", 2, 10.0), ("A", 3, None), ("A", 4, 12.0)], "k string, seen int, v double")
    assert windows.known_on(df, ["k"], "seen", F.lit(2), [F.col("v")]).first().seen == 2
    assert [(r.seen, r.old_value, r.v) for r in windows.restatements(df, ["k"], "seen", "v", []).orderBy("seen").collect()] == [(3, 10.0, None), (4, None, 12.0)]


def test_the_queries_of_issues_run_the_operators(spark, monkeypatch):
    called = []
    monkeypatch.setattr(reference, "table", lambda s, d, t: s.createDataFrame([(1, "error"), (1, "view"), (2, None)], "user_id long, event_type string") if t == "events" else s.createDataFrame([(1, "F"), (2, "O"), (3, "P"), (4, None)], "o_orderkey long, o_orderstatus string"))
    for name in ("time_zone_issue", "missing_keys"):
        monkeypatch.setattr(clean, name, lambda *a, name=name, f=getattr(clean, name): called.append(name) or f(*a))
    assert sorted(map(tuple, reference.tz_mismatch(spark, "").collect())) == [(1, "timezone_mismatch", 1)]
    assert sorted(map(tuple, reference.required_keys(spark, "").collect())) == [(1, "open;low"), (2, "low")]
    assert called == ["time_zone_issue", "missing_keys"]
