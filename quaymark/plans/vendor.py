"""Queries that run the readers of vendor bodies, the cleaning with issues, and the catalog and run operators, each beside its SQL.

The given tables hold no raw bodies, so each query writes the bodies from a table's rows as a vendor
would send them and reads them back by the operator; the SQL says what must come of the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.functions import expr
from quaymark.operators import catalog, clean, coverage, monitor, prices, windows
from quaymark.schemas import ENDPOINTS, FUND_SECTORS
from quaymark.sources import readers
from quaymark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name with its SQL."""

    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _day(text: str) -> Column:
    return F.lit(dt.date.fromisoformat(text))


def _text(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


def _bar(key: str, stamp: Column, **fields: str) -> Column:
    """Body of a series of one bar; a null value leaves its field out."""
    bar = F.map_filter(F.create_map(*[x for name, c in fields.items() for x in (F.lit(name.replace("_", ". ")), F.col(c).cast("string"))]), lambda k, v: v.isNotNull())
    return F.to_json(F.create_map(F.lit(key), F.create_map(stamp, bar)))


_N = r"regexp_matches(CAST({0} AS VARCHAR), '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')"
_NUM = "CASE WHEN " + _N + " THEN TRY_CAST(trim({0}) AS DOUBLE) END"
_MEANT = "CASE WHEN {0} IN ('None', '', '.') THEN NULL ELSE {0} END"


# -- readers ----------------------------------------------------------------------------


def _daily_bodies(spark, data):
    d = table(spark, data, "prices_daily").filter("Date IS NOT NULL")
    return d.select(F.col("bar_id").cast("string").alias("symbol"), _bar("Time Series (Daily)", _text("Date"), **{"4_close": "Close", "6_volume": "Volume"}).alias("body"))


def _split(spark, data):
    rows = readers.series(_daily_bodies(spark, data), "Time Series (Daily)", {k: readers.DAILY_FIELDS[k] for k in ("Close", "Volume")}, "date")
    return readers.split_issues(rows, ["Close", "Volume"])


_SOUND = "Close IS NOT NULL AND isfinite(Close) AND Volume IS NOT NULL AND isfinite(Volume)"


@query(f"SELECT CAST(bar_id AS VARCHAR) AS symbol, Date, Close, Volume FROM prices_daily WHERE Date IS NOT NULL AND {_SOUND}")
def daily_json(spark, data):
    return _split(spark, data)[0]


@query(f"""SELECT CAST(bar_id AS VARCHAR) AS symbol, CASE WHEN Close IS NULL AND Volume IS NULL THEN 'empty_content' ELSE 'cast_failure' END AS issue_type, 'row ' || CAST(Date AS VARCHAR) AS detail
           FROM prices_daily WHERE Date IS NOT NULL AND NOT coalesce({_SOUND}, false)""")
def bad_row_skip(spark, data):
    return _split(spark, data)[1]


@query(f"SELECT CAST(bar_id AS VARCHAR) AS symbol, date_trunc('second', Date) AS Date, High, Low FROM prices WHERE Date IS NOT NULL AND {_SOUND.replace('Close', 'High').replace('Volume', 'Low')}")
def intraday_json(spark, data):
    stamp = F.date_format("Date", "yyyy-MM-dd HH:mm:ss")
    bodies = table(spark, data, "prices").filter("Date IS NOT NULL").select(F.col("bar_id").cast("string").alias("symbol"), _bar("Time Series (1min)", stamp, **{"2_high": "High", "3_low": "Low"}).alias("body"))
    rows = readers.series(bodies, "Time Series (1min)", {k: readers.BAR_FIELDS[k] for k in ("High", "Low")}, "timestamp_ntz")
    return readers.split_issues(rows, ["High", "Low"])[0]


@query("""SELECT c_custkey AS id, 'C' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS from_currency, 'USD' AS to_currency, DATE '2024-01-02' AS Date, CAST(c_acctbal AS VARCHAR) AS Close FROM customer WHERE c_custkey % 10 > 0""")
def forex_json(spark, data):
    pair = F.when(F.col("c_custkey") % 10 == 0, "USDUSD").otherwise(F.concat(F.lit("C"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"), F.lit("USD")))
    bodies = table(spark, data, "customer").select(pair.alias("symbol"), _bar(readers.FOREX_KEY, F.lit("2024-01-02"), **{"1_open": "c_custkey", "4_close": "c_acctbal"}).alias("body"))
    return readers.forex(bodies).select(F.col("Open").cast("bigint").alias("id"), "from_currency", "to_currency", "Date", "Close")


@query("""SELECT CAST(bar_id AS VARCHAR) AS symbol, Date, CASE WHEN isfinite(Open) THEN Open END AS Open, CASE WHEN isfinite(High) THEN High END AS High, CASE WHEN isfinite(Low) THEN Low END AS Low, CASE WHEN isfinite(Close) THEN Close END AS Close
          FROM prices_daily WHERE Date IS NOT NULL""")
def index_json(spark, data):
    fields = F.struct(_text("Date").alias("date"), *[F.coalesce(_text(c), F.lit("None")).alias(c.lower()) for c in ("Open", "High", "Low", "Close")])
    bodies = table(spark, data, "prices_daily").select(F.col("bar_id").cast("string").alias("symbol"), F.to_json(F.struct(F.array(fields).alias("data"))).alias("body"))
    return readers.index_series(bodies)


@query(f"""SELECT CAST(rec_id AS VARCHAR) AS symbol, CAST(DATE '2020-01-01' + CAST(rec_id % 900 AS INTEGER) AS DATE) AS Date, {_NUM.format('Close')} AS value, 'unit' AS unit FROM prices_raw
           WHERE {_MEANT.format('Close')} IS NULL OR {_NUM.format('Close')} IS NOT NULL""")
def commodity_points(spark, data):
    day = F.date_add(_day("2020-01-01"), (F.col("rec_id") % 900).cast("int")).cast("string")
    body = F.to_json(F.struct(F.lit("unit").alias("unit"), F.array(F.struct(day.alias("date"), F.col("Close").alias("value"))).alias("data")))
    return readers.points(table(spark, data, "prices_raw").select(F.col("rec_id").cast("string").alias("symbol"), body.alias("body")), "value")


@query("""WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS p, o_custkey AS k FROM orders)
          SELECT CAST(o_orderkey AS VARCHAR) AS symbol, 'annual' AS period, d AS fiscalDateEnding, 'USD' AS reportedCurrency, CAST(p AS FLOAT) AS totalRevenue, CAST(NULL AS FLOAT) AS netIncome FROM r
          UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'quarterly', d, NULL, CAST(NULL AS FLOAT), CAST(k AS FLOAT) FROM r""")
def statements_json(spark, data):
    report = lambda **kw: F.array(F.struct(*[v.alias(k) for k, v in kw.items()]))
    day, price, rank = F.to_date("o_orderdate").cast("string"), F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string")
    annual = report(fiscalDateEnding=day, reportedCurrency=F.lit("USD"), totalRevenue=price, netIncome=F.lit("None"))
    quarterly = report(fiscalDateEnding=day, reportedCurrency=F.lit("None"), totalRevenue=F.lit("."), netIncome=rank)
    bodies = table(spark, data, "orders").select(F.col("o_orderkey").cast("string").alias("symbol"), F.to_json(F.struct(annual.alias("annualReports"), quarterly.alias("quarterlyReports"))).alias("body"))
    rows = readers.typed(readers.reports(bodies, "annualReports", "quarterlyReports", ("reportedCurrency",)), ["totalRevenue", "netIncome"])
    return rows.drop("reportedDate")


@query("SELECT CAST(event_id AS VARCHAR) AS symbol, CASE event_type WHEN 'view' THEN 'annual' ELSE 'quarterly' END AS period, CAST(ts AS DATE) AS fiscalDateEnding, CAST(value AS FLOAT) AS eps FROM events WHERE event_type IN ('view', 'click')")
def horizon_split(spark, data):
    horizon = F.when(F.col("event_type") == "view", "fiscal year").when(F.col("event_type") == "click", "fiscal quarter").otherwise("next week")
    entry = F.struct(F.to_date("ts").cast("string").alias("date"), horizon.alias("horizon"), _text("value").alias("eps"))
    bodies = table(spark, data, "events").select(F.col("event_id").cast("string").alias("symbol"), F.to_json(F.struct(F.array(entry).alias("estimates"))).alias("body"))
    return readers.typed(readers.estimates(bodies), ["eps"])


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS transactionDate, l_linestatus AS executive, CASE l_returnflag WHEN 'N' THEN 'D' ELSE 'A' END AS acquisition_or_disposal, CAST(l_quantity AS FLOAT) AS shares FROM lineitem""")
def insider_json(spark, data):
    entry = F.struct(F.col("l_orderkey").cast("string").alias("ticker"), F.to_date("l_shipdate").cast("string").alias("transaction_date"), F.col("l_linestatus").alias("executive"), F.lit("None").alias("executive_title"),
                     F.when(F.col("l_returnflag") == "N", "D").otherwise("A").alias("acquisition_or_disposal"), F.col("l_quantity").cast("string").alias("shares"))
    bodies = table(spark, data, "lineitem").select(F.col("l_orderkey").cast("string").alias("symbol"), F.to_json(F.struct(F.array(entry).alias("data"))).alias("body"))
    return readers.typed(readers.insider_trades(bodies), ["shares"]).select("symbol", "transactionDate", "executive", "acquisition_or_disposal", "shares")


def _pages(spark, data):
    number = lambda c, name: F.col(c).alias(name)
    article = F.struct(
        "time_published", "title", "url", "source", "overall_sentiment_score", F.array(F.lit("Ann"), F.lit("Bo")).alias("authors"),
        F.array(F.struct(F.lit("earnings").alias("topic"), F.lit("0.1").alias("relevance_score")), F.struct(F.lit("earnings").alias("topic"), number("ticker_relevance_score", "relevance_score"))).alias("topics"),
        F.array(F.struct("ticker", number("ticker_relevance_score", "relevance_score"))).alias("ticker_sentiment"),
    )
    return table(spark, data, "sentiment").select(F.to_json(F.struct(F.array(article).alias("feed"))).alias("body"))


_READABLE = r"regexp_matches(time_published, '^\d{8}T\d{6}$') AND TRY_STRPTIME(time_published, '%Y%m%dT%H%M%S') IS NOT NULL"


@query(f"""SELECT TRY_STRPTIME(time_published, '%Y%m%dT%H%M%S') AS time_published, ticker, title, url, source, 'Ann;Bo' AS authors, CAST({_NUM.format('overall_sentiment_score')} AS FLOAT) AS overall_sentiment_score,
           CAST({_NUM.format('ticker_relevance_score')} AS FLOAT) AS earnings, CAST({_NUM.format('ticker_relevance_score')} AS FLOAT) AS ticker_relevance_score FROM sentiment WHERE {_READABLE}""")
def article_explode(spark, data):
    return readers.news(_pages(spark, data)).select("time_published", "ticker", "title", "url", "source", "authors", "overall_sentiment_score", "earnings", "ticker_relevance_score")


@query(f"SELECT 'GLOBAL' AS symbol, 'cast_failure' AS issue_type, 'time_published ' || coalesce(time_published, 'missing') AS detail, url FROM sentiment WHERE NOT coalesce({_READABLE}, false)")
def news_time_issues(spark, data):
    return readers.news_issues(_pages(spark, data))


_SECTOR_NAMES = (*list(FUND_SECTORS)[:5], "SPACE", "MINING")


def _profiles(spark, data):
    """A fund per order: its lines are sector weights and holdings."""
    name = F.get(F.array(*map(F.lit, _SECTOR_NAMES)), (F.col("l_linenumber") % 7).cast("int"))
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_discount", "l_tax", name.alias("sector"), F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_partkey").cast("string")).alias("symbol"))))
    funds = table(spark, data, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("symbol")).agg(lines.alias("lines"))
    sectors = F.transform("lines", lambda x: F.struct(x["sector"].alias("sector"), x["l_discount"].cast("string").alias("weight")))
    holdings = F.transform("lines", lambda x: F.struct(x["symbol"].alias("symbol"), x["l_tax"].cast("string").alias("weight")))
    body = F.to_json(F.struct(F.lit("n/a").alias("net_assets"), F.size("lines").cast("string").alias("portfolio_turnover"), sectors.alias("sectors"), holdings.alias("holdings")))
    return readers.fund_profiles(funds.select("symbol", body.alias("body")), FUND_SECTORS)


_MAPPED = [(i, FUND_SECTORS[n]) for i, n in enumerate(_SECTOR_NAMES) if n in FUND_SECTORS]


@query("SELECT CAST(l_orderkey AS VARCHAR) AS symbol, " + ", ".join(f"CAST(arg_max(l_discount, (l_linenumber, l_partkey, l_discount)) FILTER (WHERE l_linenumber % 7 = {i}) AS FLOAT) AS {c}" for i, c in _MAPPED) + ", CAST(round(sum(l_discount) FILTER (WHERE l_linenumber % 7 > 4), 4) AS FLOAT) AS other, CAST(count(*) AS FLOAT) AS portfolio_turnover FROM lineitem GROUP BY 1")
def sector_pivot_other(spark, data):
    return _profiles(spark, data).select("symbol", *[c for _, c in _MAPPED], F.round(F.col("other").cast("double"), 4).cast("float").alias("other"), "portfolio_turnover")


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS symbol, count(*) FILTER (WHERE l_returnflag <> 'N') AS kept, nullif(string_agg(CASE WHEN l_returnflag <> 'N' THEN CAST(l_partkey AS VARCHAR) END, ';' ORDER BY l_linenumber, l_partkey), '') AS symbols FROM lineitem GROUP BY 1""")
def holdings_array(spark, data):
    held = F.transform("holdings", lambda h: h["symbol"])
    return _profiles(spark, data).select("symbol", F.coalesce(F.size("holdings"), F.lit(0)).cast("bigint").alias("kept"), F.array_join(held, ";").alias("symbols"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'av_throttle' WHEN 'purchase' THEN 'entitlement' ELSE 'structure_error' END AS kind FROM events")
def body_classes(spark, data):
    t = F.col("event_type")
    body = (
        F.when(t == "view", '{"Meta Data": {}}').when(t == "click", '{"Note": "Thank you, premium plans answer more calls a minute."}').when(t == "purchase", '{"Information": "This key is Not yet entitled to the endpoint."}')
        .when(t == "signup", "<html>").otherwise('{"Error Message": "Invalid call."}')
    )
    return table(spark, data, "events").select("event_id", readers.body_class(body).alias("kind"))


@query("""SELECT 'K' || c_custkey AS symbol, 'Cryptocurrency K' || c_custkey || ' for Market USD' AS name FROM customer WHERE c_nationkey % 3 = 0
          UNION ALL SELECT CAST(s_suppkey AS VARCHAR) || 'USD', s_name || ' to US Dollar' FROM supplier WHERE s_suppkey % 10 > 0
          UNION ALL SELECT 'X' || p_partkey, p_name FROM part""")
def list_catalogs(spark, data):
    c = table(spark, data, "customer").select(F.concat(F.lit("K"), "c_custkey").alias("from_currency"), F.when(F.col("c_nationkey") % 3 == 0, "USD").otherwise("EUR").alias("to_currency"))
    s = table(spark, data, "supplier").select(F.when(F.col("s_suppkey") % 10 == 0, "USD").otherwise(F.col("s_suppkey").cast("string")).alias("currency code"), F.col("s_name").alias("currency name"))
    p = table(spark, data, "part").select(F.to_json(F.create_map(F.concat(F.lit("X"), "p_partkey"), F.col("p_name"))).alias("body"))
    return readers.crypto_catalog(c).unionByName(readers.currency_pairs(s)).unionByName(readers.index_catalog(p))


@query("SELECT n_nationkey, n_name, CASE n_nationkey % 3 WHEN 0 THEN 'gold_silver' WHEN 1 THEN 'monthly' ELSE 'structure_error' END AS class FROM nation")
def commodity_classes(spark, data):
    symbol = F.when(F.col("n_nationkey") % 3 == 0, "XAU").when(F.col("n_nationkey") % 3 == 1, "WHEAT").otherwise("RICE")
    return readers.with_commodity_class(table(spark, data, "nation").select("n_nationkey", "n_name", symbol.alias("symbol"))).select("n_nationkey", "n_name", "class")


@query("SELECT s_suppkey AS symbol, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey || '_full_1min.csv' END AS file FROM supplier")
def file_lookup(spark, data):
    s = table(spark, data, "supplier")
    files = s.filter("s_suppkey % 4 = 0").select(F.concat("s_suppkey", F.lit("_full_1min.csv")).alias("file"))
    files = files.select(F.replace("file", F.lit("_full_1min"), F.lit("_full")).alias("file"))
    got = readers.located(s.select(F.col("s_suppkey").cast("string").alias("symbol")), files)
    return got.select(F.col("symbol").cast("bigint").alias("symbol"), F.replace("file", F.lit("_full"), F.lit("_full_1min")).alias("file"))


# -- cleaning ---------------------------------------------------------------------------

_LOST = "count(*) FILTER (WHERE " + _MEANT + " IS NOT NULL AND " + _NUM + " IS NULL)"


@query(" UNION ALL ".join(f"SELECT * FROM (SELECT ticker, 'cast_failure' AS issue_type, '{c}' AS detail, {_LOST.format(c)} AS n FROM sentiment GROUP BY ticker) WHERE n > 0" for c in ("overall_sentiment_score", "ticker_relevance_score")))
def lenient_cast_issues(spark, data):
    return clean.cast_columns(table(spark, data, "sentiment"), "ticker", ["overall_sentiment_score", "ticker_relevance_score"])[1]


@query(f"SELECT ticker, rec_id, {_NUM.format('overall_sentiment_score')} AS overall_sentiment_score FROM sentiment")
def lenient_cast(spark, data):
    return clean.cast_columns(table(spark, data, "sentiment").select("ticker", "rec_id", "overall_sentiment_score"), "ticker", ["overall_sentiment_score"])[0]


@query("""SELECT symbol, 'cast_failure' AS issue_type, CAST(n AS VARCHAR) || ' null values' AS detail FROM (SELECT symbol, sum(CAST(Open IS NULL AS INTEGER) + CAST(Close IS NULL AS INTEGER) + CAST(Volume IS NULL AS INTEGER)) AS n FROM prices GROUP BY symbol) WHERE n > 0""")
def null_count_issues(spark, data):
    return clean.null_issues(table(spark, data, "prices"), "symbol", ["Open", "Close", "Volume"])


# -- catalogs ---------------------------------------------------------------------------


def _listed(spark, data, name, key, test):
    t = table(spark, data, name).filter(test)
    return t.select(F.col(key).alias("symbol"))


def _states(spark, data):
    """Last state from customers, today's listing from suppliers and parts; names tell which side they are from."""
    c, p = table(spark, data, "customer"), table(spark, data, "part")
    day = lambda k: F.date_add(_day("2010-01-01"), (F.col(k) % 1000).cast("int"))
    k = F.col("c_custkey")
    old = c.select(k.alias("symbol"), F.col("c_name").alias("name"), F.when(k % 3 > 0, "Energy").alias("sector"), day("c_custkey").alias("ipo"), F.when(k % 5 == 0, _day("2020-01-01")).alias("delisting"), F.when(k % 5 == 0, "Delisted").otherwise("Active").alias("status"))
    q = F.col("p_partkey")
    fresh = p.filter("p_partkey % 4 > 0").select(q.alias("symbol"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("sector"), F.date_add(day("p_partkey"), -5).alias("ipo"), F.lit(None).cast("date").alias("delisting"), F.when(q % 7 == 0, "Delisted").otherwise("Active").alias("status"))
    lookup = table(spark, data, "supplier").select(F.col("s_suppkey").alias("symbol"), F.concat(F.lit("S"), "s_nationkey").alias("sector"))
    return old, fresh, lookup


_STATES = """o AS (SELECT c_custkey AS symbol, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN 'Energy' END AS sector, CAST(DATE '2010-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS ipo, CASE WHEN c_custkey % 5 = 0 THEN DATE '2020-01-01' END AS delisting,
                  CASE WHEN c_custkey % 5 = 0 THEN 'Delisted' ELSE 'Active' END AS status FROM customer),
             f AS (SELECT p_partkey AS symbol, p_name AS name, CAST(NULL AS VARCHAR) AS sector, CAST(DATE '2010-01-01' + CAST(p_partkey % 1000 AS INTEGER) - 5 AS DATE) AS ipo, CAST(NULL AS DATE) AS delisting, CASE WHEN p_partkey % 7 = 0 THEN 'Delisted' ELSE 'Active' END AS status FROM part WHERE p_partkey % 4 > 0),
             l AS (SELECT s_suppkey AS symbol, min('S' || s_nationkey) AS sector FROM supplier GROUP BY 1)"""


@query(f"""WITH {_STATES} SELECT b.symbol, name, coalesce(b.sector, l.sector) AS sector, ipo, delisting, status FROM (SELECT * FROM o UNION ALL SELECT * FROM f WHERE symbol NOT IN (SELECT symbol FROM o)) b LEFT JOIN l ON l.symbol = b.symbol""")
def catalog_init(spark, data):
    return catalog.initial_catalog(*_states(spark, data))


@query(f"""WITH {_STATES}, j AS (SELECT coalesce(o.symbol, f.symbol) AS symbol, coalesce(o.name, f.name) AS name, CASE WHEN o.symbol IS NULL THEN coalesce(l.sector, 'Other') ELSE o.sector END AS sector, o.ipo AS oi, f.ipo AS fi, o.delisting AS od, o.status AS os, f.delisting AS fd, f.status AS fs,
             o.symbol IS NULL AS added, f.symbol IS NULL AS gone FROM o FULL JOIN f ON o.symbol = f.symbol LEFT JOIN l ON l.symbol = coalesce(o.symbol, f.symbol))
    SELECT symbol, name, sector, least(oi, fi) AS ipo, CASE WHEN gone THEN coalesce(od, DATE '2020-06-01') ELSE fd END AS delisting,
      CASE WHEN added THEN fs WHEN gone AND od IS NULL THEN 'Corrupted' WHEN gone THEN os WHEN os = 'Delisted' AND fs = 'Active' THEN 'Active' WHEN os <> 'Delisted' AND fs = 'Delisted' THEN 'Delisted' ELSE os END AS status FROM j""")
def catalog_update(spark, data):
    old, fresh, lookup = _states(spark, data)
    return catalog.update_catalog(old, fresh, old.limit(0), _day("2020-06-01"), lookup, ("name", "sector"))


@query("SELECT c_custkey AS symbol, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey <= 3 OR c_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey > 3 ORDER BY sha256('a:' || c_custkey), c_custkey LIMIT 12)")
def catalog_trim(spark, data):
    c = table(spark, data, "customer").select(F.col("c_custkey").alias("symbol"))
    o = table(spark, data, "orders").select(F.col("o_custkey").alias("symbol"), "o_orderkey")
    return catalog.trimmed(c, o, c.filter("symbol <= 3"), 12, "a")[1]


@query("SELECT p_partkey, p_name FROM (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS n FROM part) WHERE (n - 1) % 7 = 0 ORDER BY p_partkey LIMIT 9")
def strided_sample(spark, data):
    return catalog.strided(table(spark, data, "part").select("p_partkey", "p_name"), "p_partkey", 7, 9)


@query("SELECT l_suppkey AS symbol, CAST(sum(greatest(coalesce(date_diff('month', l_shipdate, l_receiptdate) + 1, 0), 0)) AS BIGINT) AS months FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS l_receiptdate FROM lineitem) GROUP BY 1")
def listing_months(spark, data):
    first = F.to_date("l_shipdate")
    rows = table(spark, data, "lineitem").select(F.col("l_suppkey").alias("symbol"), first.alias("a"), F.date_add(first, F.col("l_quantity").cast("int")).alias("z"))
    return prices.listed_months(rows, "symbol", F.col("a"), F.col("z"))


@query("""WITH d AS (SELECT bar_id, symbol, Date, Close, SplitCoefficient AS k FROM prices_daily WHERE symbol IS NOT NULL AND Date IS NOT NULL AND SplitCoefficient > 0 AND isfinite(SplitCoefficient)),
          s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, Date ORDER BY bar_id) AS rn FROM d) WHERE rn = 1)
          SELECT bar_id, round(CAST(Close AS DOUBLE) / exp(coalesce(sum(ln(CAST(k AS DOUBLE))) OVER (PARTITION BY symbol ORDER BY Date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)), 4) AS sa_close FROM s""")
def split_adjusted(spark, data):
    d = table(spark, data, "prices_daily").filter("symbol IS NOT NULL AND Date IS NOT NULL AND SplitCoefficient > 0 AND SplitCoefficient < float('inf')")
    once = windows.latest_of(d.select("bar_id", "symbol", "Date", F.col("Close").cast("double").alias("Close"), F.col("SplitCoefficient").cast("double").alias("SplitCoefficient")), ["symbol", "Date"], [F.col("bar_id")])
    return prices.split_adjust(once).select("bar_id", F.round("sa_close", 4).alias("sa_close"))


# -- runs -------------------------------------------------------------------------------


@query("SELECT coalesce(bool_or(CAST(TRY_CAST(nullif(regexp_extract(replace(\"timestamp\", chr(10), ''), '\\d{4}-\\d{2}-\\d{2}'), '') AS DATE) AS DATE) > DATE '2024-01-01' AND symbol = 'GLOBAL' AND endpoint = 'sentiment' AND TRY_CAST(nullif(regexp_extract(replace(\"timestamp\", chr(10), ''), '\\d{4}-\\d{2}-\\d{2}'), '') AS DATE) <= DATE '2026-01-01'), false) AS full_rerun FROM ingestion_report")
def replay_flag(spark, data):
    return coverage.full_rerun(table(spark, data, "ingestion_report"), expr.lax_date("timestamp"), _day("2024-01-01"), _day("2026-01-01"))


@query("SELECT rec_id FROM ingestion_report WHERE asset_type IS NULL OR endpoint IS NULL OR NOT (" + " OR ".join(f"(asset_type = '{k}' AND endpoint IN ({', '.join(repr(x) for x in v)}))" for k, v in ENDPOINTS.items()) + ")")
def replay_skipped(spark, data):
    return coverage.skipped_of(table(spark, data, "ingestion_report"), ENDPOINTS).select("rec_id")


@query("SELECT rec_id, endpoint FROM ingestion_report WHERE endpoint IS DISTINCT FROM 'prices' UNION ALL SELECT -rec_id, endpoint FROM ingestion_report WHERE endpoint = 'prices' AND issue_type = 'av_throttle'")
def replace_endpoint_rows(spark, data):
    r = table(spark, data, "ingestion_report").select("rec_id", "endpoint", "issue_type")
    fresh = r.filter("endpoint = 'prices' AND issue_type = 'av_throttle'").withColumn("rec_id", -F.col("rec_id"))
    return coverage.replace_endpoint(r, "prices", fresh).select("rec_id", "endpoint")


@query("SELECT 1 AS k, (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AS previous UNION ALL SELECT 2, DATE '2024-01-08'")
def high_water_mark(spark, data):
    days = table(spark, data, "events").select(F.to_date("ts").alias("day"))
    state = table(spark, data, "orders").select(F.to_date("o_orderdate").alias("date"))
    usual = windows.previous_date(days, "day", state, _day("2024-01-15"))
    first = windows.previous_date(days.filter("day = '2024-01-15'"), "day", state, _day("2024-01-15"))
    return usual.select(F.lit(1).alias("k"), "previous").unionByName(first.select(F.lit(2).alias("k"), "previous"))


@query("""WITH p AS (SELECT CAST(ts AS DATE) AS page, min(ts) AS oldest FROM events GROUP BY 1), b AS (SELECT *, strftime(date_trunc('minute', oldest) + INTERVAL 1 MINUTE, '%Y%m%dT%H%M') AS bound, CASE WHEN day(page) % 2 = 0 THEN strftime(page, '%Y%m%dT0000') ELSE strftime(page + INTERVAL 1 DAY, '%Y%m%dT0000') END AS asked FROM p)
          SELECT page, oldest, CASE WHEN bound >= asked THEN strftime(strptime(asked, '%Y%m%dT%H%M') - INTERVAL 1 MINUTE, '%Y%m%dT%H%M') ELSE bound END AS next_to FROM b""")
def news_pages(spark, data):
    day = F.to_date("ts")
    asked = F.date_format(F.when(F.day(day) % 2 == 0, day).otherwise(F.date_add(day, 1)), "yyyyMMdd'T'0000")
    return windows.next_pages(table(spark, data, "events").select(day.alias("page"), "ts", asked.alias("asked")), "page", "ts", "asked")


@query("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20'")
def synced_folders(spark, data):
    return windows.since_cutoff(table(spark, data, "events").select(F.to_date("ts").alias("day")).distinct(), "day", _day("2024-01-20"))


@query("""WITH p AS (SELECT o_orderpriority AS k, count(*) FILTER (WHERE o_orderstatus = 'F') AS a, count(*) FILTER (WHERE o_orderstatus = 'O') AS b FROM orders GROUP BY 1)
          SELECT k, format('{:,}', a) AS previous, format('{:,}', b) AS current, CASE WHEN b >= a THEN '+' ELSE '' END || format('{:,}', b - a) AS delta FROM p""")
def report_figures(spark, data):
    o = table(spark, data, "orders")
    half = lambda s: o.groupBy(F.col("o_orderpriority").alias("k")).agg(F.count_if(F.col("o_orderstatus") == s).alias("v"))
    d = monitor.metric_diff(half("F"), half("O"), "k", "v")
    return d.select("k", expr.thousands("previous").alias("previous"), expr.thousands("current").alias("current"), expr.signed("delta").alias("delta"))
