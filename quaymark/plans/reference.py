"""Queries of the data-processing operators over the whole given tables, each beside its SQL.

Symbols, dates and statuses that the given tables lack are derived from their columns the
same way in both forms; nothing is cut from the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.functions import expr
from quaymark.operators import catalog, clean, coverage, monitor, prices, windows
from quaymark.schemas import SECTORS
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


def _events(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "events").withColumn("day", F.to_date("ts"))


# -- windows ---------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE CAST(l_shipdate AS DATE) > DATE '1997-06-01' AND CAST(l_shipdate AS DATE) <= DATE '1997-06-08'")
def half_open_window(spark, data):
    day = F.to_date("l_shipdate")
    return table(spark, data, "lineitem").filter(windows.half_open(day, _day("1997-06-01"), _day("1997-06-08"))).select("l_orderkey", "l_linenumber", day.alias("day"))


@query("""SELECT count(*) FILTER (WHERE CAST(ts AS DATE) > DATE '2024-01-10' AND CAST(ts AS DATE) <= DATE '2024-01-15') AS by_day,
                 count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-15') AS by_midnight FROM events""")
def window_midnight_trap(spark, data):
    a, b = _day("2024-01-10"), _day("2024-01-15")
    midnight = lambda d: d.cast("timestamp_ntz")
    return table(spark, data, "events").agg(
        F.count_if(windows.half_open(F.to_date("ts"), a, b)).alias("by_day"), F.count_if(windows.half_open(F.col("ts"), midnight(a), midnight(b))).alias("by_midnight")
    )


_RUNS = (("1997-06-05", "1997-06-08"), ("1997-05-20", "1997-06-08"), ("1998-01-10", "1998-01-10"))


@query("""WITH runs(previous, folder) AS (VALUES (DATE '1997-06-05', DATE '1997-06-08'), (DATE '1997-05-20', DATE '1997-06-08'), (DATE '1998-01-10', DATE '1998-01-10'))
          SELECT previous, folder, l_suppkey AS symbol, count(*) AS n_rows, max(CAST(l_shipdate AS DATE)) AS last,
                 round(count(*) FILTER (WHERE l_discount = 0) / count(*), 6) AS null_ratio, count(*) FILTER (WHERE l_discount = 0) * 100 < count(*) AS ok
          FROM lineitem JOIN runs ON CAST(l_shipdate AS DATE) > least(previous, folder - 7) AND CAST(l_shipdate AS DATE) <= folder GROUP BY ALL""")
def seven_day_floor(spark, data):
    day = F.to_date("l_shipdate")
    runs = F.array(*[F.struct(_day(p).alias("previous"), _day(f).alias("folder")) for p, f in _RUNS])
    hit = F.filter(runs, lambda r: windows.half_open(day, windows.with_floor(r["previous"], r["folder"]), r["folder"]))
    rows = table(spark, data, "lineitem").select(day.alias("day"), F.col("l_suppkey").alias("symbol"), F.nullif("l_discount", F.lit(0.0)).alias("v"), F.inline(hit))
    nulls = F.count_if(F.col("v").isNull())
    return rows.groupBy("previous", "folder", "symbol").agg(
        F.count("*").alias("n_rows"), F.max("day").alias("last"), F.round(nulls / F.count("*"), 6).alias("null_ratio"), (nulls * 100 < F.count("*")).alias("ok")
    )


@query("""SELECT k, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders, (VALUES (1), (3)) t(k)
          WHERE CAST(o_orderdate AS DATE) >= CAST(DATE '2000-02-29' - to_months(CAST(12 * k AS INTEGER)) AS DATE)""")
def since_window_leap(spark, data):
    day = F.to_date("o_orderdate")
    o = table(spark, data, "orders")
    parts = [o.filter(windows.since(day, _day("2000-02-29"), k)).select(F.lit(k).alias("k"), "o_orderkey", day.alias("day")) for k in (1, 3)]
    return parts[0].unionByName(parts[1])


@query("""WITH l AS (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS t FROM events)
          SELECT event_id, CASE WHEN isodow(t) >= 6 OR hour(t) >= 20 THEN CAST(t AS DATE) ELSE CAST(t AS DATE) - 1 END AS traded FROM l""")
def trading_date(spark, data):
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts"))
    return table(spark, data, "events").select("event_id", expr.trading_date(local).alias("traded"))


@query("""WITH b AS (SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS z, o_custkey % 7 = 0 AS inverted FROM orders GROUP BY o_custkey)
          SELECT o_custkey, CAST(unnest(generate_series(CASE WHEN inverted THEN z + INTERVAL 1 MONTH ELSE a END, z, INTERVAL 1 MONTH)) AS DATE) AS month FROM b""")
def month_sequence(spark, data):
    b = table(spark, data, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    first = F.when(F.col("o_custkey") % 7 == 0, F.add_months(F.to_date("z"), 1)).otherwise(F.to_date("a"))
    return b.select("o_custkey", F.explode(expr.month_sequence(first, F.to_date("z"))).alias("month"))


@query("SELECT max(CAST(ts AS DATE)) AS day FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20'")
def latest_partition(spark, data):
    return windows.latest_partition(_events(spark, data), "day", _day("2024-01-20"))


# -- catalogs --------------------------------------------------------------------------


@query("""SELECT o_custkey AS symbol, o_orderkey, o_orderstatus, min_date AS ipo FROM (SELECT *, min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS min_date,
            row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def listing_collapse(spark, data):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    o = table(spark, data, "orders").select(F.col("o_custkey").alias("symbol"), "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("ipo"))
    return catalog.collapse_listing(o, "symbol", [rank, F.col("o_orderkey")], "ipo")


@query("""WITH a AS (SELECT 'T' || s_suppkey AS symbol, s_name AS name FROM supplier), b AS (SELECT 'T' || c_custkey AS symbol, c_name AS name FROM customer)
          SELECT * FROM a UNION ALL SELECT * FROM b WHERE symbol NOT IN (SELECT symbol FROM a)""")
def source_merge_precedence(spark, data):
    a = table(spark, data, "supplier").select(F.concat(F.lit("T"), "s_suppkey").alias("symbol"), F.col("s_name").alias("name"))
    b = table(spark, data, "customer").select(F.concat(F.lit("T"), "c_custkey").alias("symbol"), F.col("c_name").alias("name"))
    return catalog.preferred_source(a, b, "symbol")


_SNAPS = """o AS (SELECT o_custkey AS symbol, min(CAST(o_orderdate AS DATE)) AS ipo, CASE WHEN max(o_orderkey) % 3 = 0 THEN max(CAST(o_orderdate AS DATE)) END AS delisting,
                  CASE max(o_orderkey) % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'Corrupted' WHEN 2 THEN 'Delisted' END AS status FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
            f AS (SELECT o_custkey AS symbol, min(CAST(o_orderdate AS DATE)) AS ipo, CASE WHEN max(o_orderkey) % 5 = 0 THEN max(CAST(o_orderdate AS DATE)) END AS delisting,
                  CASE max(o_orderkey) % 2 WHEN 0 THEN 'Active' ELSE 'Delisted' END AS status FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1)"""


def _snaps(spark, data):
    o = table(spark, data, "orders").select(F.col("o_custkey").alias("symbol"), "o_orderkey", F.to_date("o_orderdate").alias("d"))
    last, top = F.max("d"), F.max("o_orderkey")
    old = o.filter(F.col("d") < _day("1998-01-01")).groupBy("symbol").agg(F.min("d").alias("ipo"), last.alias("l"), top.alias("k"))
    new = o.filter(F.col("d") >= _day("2001-01-01")).groupBy("symbol").agg(F.min("d").alias("ipo"), last.alias("l"), top.alias("k"))
    k = F.col("k")
    old = old.select("symbol", "ipo", F.when(k % 3 == 0, F.col("l")).alias("delisting"), F.when(k % 4 == 0, "Active").when(k % 4 == 1, "Corrupted").when(k % 4 == 2, "Delisted").alias("status"))
    new = new.select("symbol", "ipo", F.when(k % 5 == 0, F.col("l")).alias("delisting"), F.when(k % 2 == 0, "Active").otherwise("Delisted").alias("status"))
    return old, new


@query(f"WITH {_SNAPS} SELECT o.symbol, o.status AS first_value, f.status AS second_value FROM o JOIN f USING (symbol) WHERE o.status <> f.status")
def status_disagreement(spark, data):
    old, new = _snaps(spark, data)
    return catalog.disagreements(old, new, "symbol", "status")


@query(f"""WITH {_SNAPS}, x AS (SELECT DISTINCT s_suppkey AS symbol FROM supplier WHERE s_acctbal > 4000),
    j AS (SELECT coalesce(o.symbol, f.symbol) AS symbol, o.ipo AS oi, o.delisting AS od, o.status AS os, f.ipo AS fi, f.delisting AS fd, f.status AS fs, o.symbol IS NULL AS added, f.symbol IS NULL AS gone,
                 coalesce(o.symbol, f.symbol) IN (SELECT symbol FROM x) AS el FROM o FULL JOIN f ON o.symbol = f.symbol)
    SELECT symbol, least(oi, fi) AS ipo, CASE WHEN gone THEN coalesce(od, DATE '1997-12-01') ELSE fd END AS delisting,
      CASE WHEN added THEN fs WHEN gone AND od IS NULL THEN CASE WHEN el THEN 'Delisted' ELSE 'Corrupted' END
           WHEN gone AND os = 'Corrupted' AND (od < DATE '1997-12-01' - 30 OR el) THEN 'Delisted' WHEN gone THEN os
           WHEN os IN ('Corrupted', 'Delisted') AND fs = 'Active' THEN 'Active' WHEN os NOT IN ('Corrupted', 'Delisted') AND fs = 'Delisted' THEN 'Delisted' ELSE os END AS status FROM j""")
def catalog_merge_full(spark, data):
    old, new = _snaps(spark, data)
    other = table(spark, data, "supplier").filter("s_acctbal > 4000").select(F.col("s_suppkey").alias("symbol"))
    return catalog.merge_listing(old, new, other, _day("1997-12-01"))


@query(f"""WITH {_SNAPS}, j AS (SELECT coalesce(o.symbol, f.symbol) AS symbol, o.delisting AS od, o.status AS os, f.symbol IS NULL AS gone FROM o FULL JOIN f ON o.symbol = f.symbol)
    SELECT symbol, CASE WHEN gone THEN coalesce(od, DATE '1997-12-01') WHEN os IN ('Corrupted', 'Delisted') THEN NULL ELSE od END AS delisting,
      CASE WHEN gone AND od IS NULL THEN 'Corrupted' WHEN gone AND od < DATE '1997-12-01' - 30 THEN 'Delisted' WHEN gone THEN os WHEN os IN ('Corrupted', 'Delisted') THEN 'Active' ELSE os END AS status FROM j""")
def catalog_merge_simple(spark, data):
    old, new = _snaps(spark, data)
    return catalog.merge_simple(old, new, _day("1997-12-01"))


@query("""WITH u AS (SELECT c_custkey AS k, 0 AS p FROM customer WHERE c_nationkey < 10 UNION ALL SELECT s_suppkey, 1 FROM supplier UNION ALL SELECT p_partkey, 2 FROM part)
          SELECT k AS symbol, CASE min(p) WHEN 0 THEN 'stocks' WHEN 1 THEN 'etfs' ELSE 'forex' END AS asset_type FROM u GROUP BY k""")
def lookup_priority(spark, data):
    a = table(spark, data, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("symbol"))
    b, c = table(spark, data, "supplier").select(F.col("s_suppkey").alias("symbol")), table(spark, data, "part").select(F.col("p_partkey").alias("symbol"))
    return catalog.first_catalog([("stocks", a), ("etfs", b), ("forex", c)])


# -- casts -----------------------------------------------------------------------------

_NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_NUM_SQL = f"CASE WHEN regexp_matches({{0}}, '{_NUM}') THEN TRY_CAST(trim({{0}}) AS DOUBLE) END"
_CLEAN_SQL = "CASE WHEN {0} IN ('None', '', '.') THEN NULL ELSE {0} END"


@query("SELECT rec_id, TRY_CAST(nullif(regexp_extract(replace(time_published, chr(10), ''), '\\d{4}-\\d{2}-\\d{2}'), '') AS DATE) AS day FROM sentiment")
def lax_date(spark, data):
    return table(spark, data, "sentiment").select("rec_id", expr.lax_date("time_published").alias("day"))


@query(f"""SELECT rec_id, nullif(concat_ws(',', CASE WHEN {_NUM_SQL.format('overall_sentiment_score')} IS NULL THEN 'score' END, CASE WHEN {_NUM_SQL.format('ticker_relevance_score')} IS NULL THEN 'relevance' END, CASE WHEN title IS NULL THEN 'title' END), '') AS cast_issues FROM sentiment""")
def cast_issue_list(spark, data):
    checks = [("score", expr.number("overall_sentiment_score").isNull()), ("relevance", expr.number("ticker_relevance_score").isNull()), ("title", F.col("title").isNull())]
    return table(spark, data, "sentiment").select("rec_id", expr.issue_list(checks).alias("cast_issues"))


@query(f"SELECT rec_id, {_CLEAN_SQL.format('ticker')} AS ticker, {_CLEAN_SQL.format('overall_sentiment_label')} AS label FROM sentiment")
def null_sentinels(spark, data):
    return table(spark, data, "sentiment").select("rec_id", expr.without_sentinels("ticker").alias("ticker"), expr.without_sentinels("overall_sentiment_label").alias("label"))


@query("SELECT rec_id, CASE WHEN regexp_matches(time_published, '^\\d{8}T\\d{6}$') THEN strftime(date_trunc('minute', TRY_STRPTIME(time_published, '%Y%m%dT%H%M%S')) + INTERVAL 1 MINUTE, '%Y%m%dT%H%M') END AS bound FROM sentiment")
def page_bounds(spark, data):
    return table(spark, data, "sentiment").select("rec_id", expr.next_page_bound(expr.news_stamp("time_published")).alias("bound"))


@query("""SELECT p_partkey, 'stocks_' || replace(replace(replace(replace(p_name, '%', '%25'), ' ', '%20'), '/', '%2F'), '#', '%23') || '_annual.parquet' AS file, p_name AS symbol FROM part""")
def file_names(spark, data):
    p = table(spark, data, "part").select("p_partkey", F.concat(F.lit("stocks_"), expr.safe_file_name("p_name"), F.lit("_annual.parquet")).alias("file"))
    return p.withColumn("symbol", expr.symbol_of_file("file"))


@query("""SELECT msg_id FROM (SELECT msg_id, row_number() OVER (PARTITION BY url, ticker ORDER BY time_published DESC, msg_id) AS rn FROM all_messages WHERE ticker IS NOT NULL) WHERE rn = 1""")
def news_dedupe(spark, data):
    m = table(spark, data, "all_messages").select("msg_id", "url", "ticker", "time_published").filter("ticker IS NOT NULL")
    return windows.latest_of(m, ["url", "ticker"], [F.col("time_published").desc(), F.col("msg_id")]).select("msg_id")


@query("""SELECT DISTINCT c_custkey AS symbol FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE c_nationkey % 3 > 0 AND s_nationkey % 2 = 0""")
def type_collision(spark, data):
    status = lambda test: F.when(test, "Active").otherwise("Delisted").alias("status")
    c = table(spark, data, "customer").select(F.col("c_custkey").alias("symbol"), status(F.col("c_nationkey") % 3 > 0))
    return catalog.active_collisions(c, table(spark, data, "supplier").select(F.col("s_suppkey").alias("symbol"), status(F.col("s_nationkey") % 2 == 0)))


@query("SELECT rec_id, coalesce(CASE upper(trim(ticker)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SECTORS.items() if k.isupper()) + " END, 'Other') AS plain, coalesce(CASE mod(rec_id, 15) " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(SECTORS.values())) + " END, 'Other') AS sector FROM sentiment")
def sector_normalize(spark, data):
    names = F.array(*[F.lit(f" {k} ") for k in SECTORS])
    sent = F.get(names, (F.col("rec_id") % 15).cast("int"))
    return table(spark, data, "sentiment").select("rec_id", expr.normalised(F.upper("ticker"), SECTORS).alias("plain"), expr.normalised(sent, SECTORS).alias("sector"))


# -- prices ----------------------------------------------------------------------------

_SERIES = """s AS (SELECT l_partkey AS symbol, CAST(l_shipdate AS DATE) AS Date, max(l_extendedprice) AS c, max(l_suppkey) AS k, max(l_discount) AS off FROM lineitem GROUP BY 1, 2),
    t AS (SELECT *, c / (1 + k % 4) AS sa, c / (1 + k % 4) * (1 - 0.01 * (k % 3)) AS sda FROM s)"""


@query(f"""WITH {_SERIES}, r AS (SELECT *, c / sa AS cum, sda / sa AS ratio FROM t WHERE off > 0),
    w AS (SELECT *, lag(cum) OVER v AS pc, lag(ratio) OVER v AS pr, lag(sa) OVER v AS ps FROM r WINDOW v AS (PARTITION BY symbol ORDER BY Date))
    SELECT symbol, Date, c AS Close, round(coalesce(pc / nullif(cum, 0), 1.0), 6) AS SplitCoefficient, round(coalesce(ps * (1 - pr / nullif(ratio, 0)) * pc, 0.0), 6) + 0 AS DividendAmount FROM w""")
def split_dividend(spark, data):
    li = table(spark, data, "lineitem").groupBy(F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").alias("Date")).agg(F.max("l_extendedprice").alias("c"), F.max("l_suppkey").alias("k"), F.max("l_discount").alias("off"))
    sa = F.col("c") / (1 + F.col("k") % 4)
    raw = li.select("symbol", "Date", F.col("c").alias("Close"))
    one = li.select("symbol", "Date", sa.alias("Close"))
    # the third variant lacks some days, which the inner joins drop
    two = li.filter("off > 0").select("symbol", "Date", (sa * (1 - F.lit(0.01) * (F.col("k") % 3))).alias("Close"))
    out = prices.corporate_actions(raw, one, two)
    return out.withColumn("DividendAmount", F.col("DividendAmount") + F.lit(0.0))


@query("""SELECT symbol, Date, bar_id FROM (SELECT symbol, Date, bar_id, row_number() OVER (PARTITION BY symbol, Date ORDER BY folder_date DESC, bar_id DESC) AS rn FROM prices_daily) WHERE rn = 1""")
def dedupe_overlap(spark, data):
    return windows.latest_of(table(spark, data, "prices_daily").select("symbol", "Date", "bar_id", "folder_date"), ["symbol", "Date"], [F.col("folder_date").desc(), F.col("bar_id").desc()]).drop("folder_date")


@query("SELECT user_id, event_type, CAST(ts AS DATE) AS day, max(event_id) AS event_id FROM events GROUP BY ALL")
def dedupe_ordered(spark, data):
    return windows.latest_of(_events(spark, data).select("user_id", "event_type", "day", "event_id"), ["user_id", "event_type", "day"], [F.col("event_id").desc()])


# -- set-like joins ---------------------------------------------------------------------


@query("SELECT msg_id, ticker FROM all_messages WHERE ticker IN (SELECT symbol FROM stocks)")
def semi_filter(spark, data):
    return table(spark, data, "all_messages").select("msg_id", "ticker").join(table(spark, data, "stocks").select(F.col("symbol").alias("ticker")), "ticker", "left_semi")


@query("""SELECT r.rec_id FROM ingestion_report r WHERE NOT EXISTS (SELECT 1 FROM ingestion_report x WHERE x.issue_type = 'av_throttle' AND x.symbol = r.symbol AND x.asset_type = r.asset_type AND x.endpoint = r.endpoint)
          UNION ALL SELECT -rec_id FROM ingestion_report WHERE issue_type = 'av_throttle'""")
def anti_report_merge(spark, data):
    r = table(spark, data, "ingestion_report").select("rec_id", "symbol", "asset_type", "endpoint", "issue_type")
    retried = r.filter("issue_type = 'av_throttle'")
    return coverage.merge_report(r.drop("issue_type"), retried, retried.drop("issue_type").withColumn("rec_id", -F.col("rec_id"))).select("rec_id")


@query("""WITH p AS (SELECT p_partkey AS k, p_size AS v, p_retailprice AS price FROM part), l AS (SELECT k, v FROM p WHERE v > 5), r AS (SELECT k, CASE WHEN v > 40 THEN v + 1 ELSE v END AS v FROM p WHERE price < 950)
          SELECT coalesce(l.k, r.k) AS k, CASE WHEN r.k IS NULL THEN 'local_only' WHEN l.k IS NULL THEN 'remote_only' ELSE 'differs' END AS class FROM l FULL JOIN r ON l.k = r.k WHERE r.k IS NULL OR l.k IS NULL OR l.v <> r.v""")
def tree_diff(spark, data):
    p = table(spark, data, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"), "p_retailprice")
    return monitor.tree_diff(p.filter("v > 5"), p.filter("p_retailprice < 950").withColumn("v", F.when(F.col("v") > 40, F.col("v") + 1).otherwise(F.col("v"))), "k", "v")


@query("SELECT p_partkey, sha256('7:' || p_partkey) AS h FROM part ORDER BY h, p_partkey LIMIT 25")
def hash_sample(spark, data):
    return table(spark, data, "part").select("p_partkey", F.sha2(F.concat(F.lit("7:"), "p_partkey"), 256).alias("h")).orderBy("h", "p_partkey").limit(25)


# -- coverage ---------------------------------------------------------------------------

_TYPES = ("view", "click", "purchase", "signup", "error")
_APPLICABLE = {"stocks": _TYPES, "etfs": ("view", "click")}
_CELLS_SQL = """sy AS (SELECT DISTINCT user_id AS symbol, CASE WHEN user_id % 3 = 0 THEN 'etfs' ELSE 'stocks' END AS asset_type FROM events),
    i AS (SELECT user_id AS symbol, event_type AS endpoint, CASE event_id % 5 WHEN 0 THEN 'structure_error' WHEN 1 THEN 'empty_content' ELSE 'cast_failure' END AS issue_type, CAST(ts AS DATE) AS day FROM events),
    le AS (SELECT DISTINCT user_id AS symbol, event_type AS endpoint FROM events WHERE value > 50),
    fl AS (SELECT symbol, endpoint, bool_or(issue_type IN ('structure_error', 'av_throttle')) AS hard, bool_or(issue_type = 'empty_content') AS empty FROM i GROUP BY 1, 2),
    ce AS (SELECT sy.symbol, sy.asset_type, e.endpoint, CASE WHEN sy.asset_type = 'etfs' AND e.endpoint NOT IN ('view', 'click') THEN NULL
             ELSE NOT (coalesce(fl.hard, false) OR (coalesce(fl.empty, false) AND NOT (e.endpoint = 'purchase' AND le.symbol IS NOT NULL))) END AS ok
           FROM sy CROSS JOIN (VALUES ('view'), ('click'), ('purchase'), ('signup'), ('error')) e(endpoint) LEFT JOIN fl ON fl.symbol = sy.symbol AND fl.endpoint = e.endpoint
           LEFT JOIN le ON le.symbol = sy.symbol AND le.endpoint = e.endpoint)"""


def _cells(spark, data):
    e = _events(spark, data)
    symbols = e.select(F.col("user_id").alias("symbol")).distinct().withColumn("asset_type", F.when(F.col("symbol") % 3 == 0, "etfs").otherwise("stocks"))
    kind = F.when(F.col("event_id") % 5 == 0, "structure_error").when(F.col("event_id") % 5 == 1, "empty_content").otherwise("cast_failure")
    issues = e.select(F.col("user_id").alias("symbol"), F.col("event_type").alias("endpoint"), kind.alias("issue_type"), "day")
    ledger = e.filter("value > 50").select(F.col("user_id").alias("symbol"), F.col("event_type").alias("endpoint")).distinct()
    return symbols, issues, ledger, coverage.finalise_matrix(symbols, issues, ledger, _APPLICABLE, _TYPES, forgiving=("purchase",))


@query("SELECT DISTINCT user_id AS symbol, 'stocks' AS asset_type, CAST(NULL AS BOOLEAN) AS prices, CAST(NULL AS BOOLEAN) AS direct, DATE '2024-02-01' AS date FROM events")
def yield_init(spark, data):
    s = table(spark, data, "events").select(F.col("user_id").alias("symbol")).distinct().withColumn("asset_type", F.lit("stocks"))
    return coverage.init_matrix(s, ["prices", "direct"], _day("2024-02-01"))


@query(f"WITH {_CELLS_SQL} SELECT symbol, asset_type, " + ", ".join(f"bool_or(ok) FILTER (WHERE endpoint = '{c}') AS \"{c}\"" for c in _TYPES) + " FROM ce GROUP BY 1, 2")
def yield_finalize(spark, data):
    return _cells(spark, data)[3]


@query(f"WITH {_CELLS_SQL} SELECT symbol, asset_type, endpoint FROM ce WHERE NOT ok AND endpoint <> 'error'")
def yield_false_triples(spark, data):
    return coverage.false_cells(_cells(spark, data)[3], _TYPES, skip=("error",))


@query(f"""WITH {_CELLS_SQL} SELECT endpoint, count(*) FILTER (WHERE ok) AS n_true, count(*) FILTER (WHERE NOT ok) AS n_false, count(*) FILTER (WHERE ok IS NULL) AS n_null,
           coalesce(round(count(*) FILTER (WHERE ok) / nullif(count(ok), 0), 4), 0.0) AS true_ratio, coalesce(round(count(*) FILTER (WHERE NOT ok) / nullif(count(ok), 0), 4), 0.0) AS false_ratio FROM ce GROUP BY 1""")
def yield_rollup(spark, data):
    return coverage.rollup_matrix(_cells(spark, data)[3], _TYPES)


@query(f"""WITH {_CELLS_SQL} SELECT DISTINCT i.symbol, sy.asset_type, i.endpoint FROM i JOIN sy USING (symbol) WHERE i.day > DATE '2024-01-10' AND i.day <= DATE '2024-01-12' AND i.endpoint <> 'sentiment'
           UNION SELECT symbol, asset_type, endpoint FROM ce WHERE NOT ok""")
def retry_plan(spark, data):
    symbols, issues, _, matrix = _cells(spark, data)
    cells = coverage.false_cells(matrix, _TYPES)
    return coverage.retry_plan(issues.join(symbols, "symbol"), cells, F.col("day"), _day("2024-01-10"), _day("2024-01-12"), symbols)


# -- monitoring -------------------------------------------------------------------------


@query("""SELECT coalesce(issue_type, 'ALL') AS issue_type, coalesce(asset_type, 'ALL') AS asset_type, coalesce(endpoint, 'ALL') AS endpoint, count(*) AS n FROM ingestion_report GROUP BY ROLLUP (issue_type, asset_type, endpoint)""")
def issue_rollup(spark, data):
    return monitor.issue_rollup(table(spark, data, "ingestion_report"), ["issue_type", "asset_type", "endpoint"])


def _probe_sql(source: str, values: tuple[str, ...], least: int) -> str:
    ratios = ", ".join(f'round(count(*) FILTER (WHERE {v} IS NULL) / count(*), 6) AS "null_{v}"' for v in values)
    reasons = ", ".join(f"""CASE WHEN "null_{v}" >= 0.01 THEN '{v} has nulls' END""" for v in values)
    return f"""SELECT *, reasons = '' AS ok FROM (SELECT *, concat_ws('; ', CASE WHEN n_rows < {least} THEN 'rows below {least}' END, {reasons}) AS reasons
               FROM (SELECT symbol, count(*) AS n_rows, max(Date) AS last, {ratios} FROM {source} GROUP BY symbol))"""


@query(_probe_sql("prices", ("Open", "High", "Low", "Close", "Volume"), 390))
def coverage_intraday(spark, data):
    return monitor.probe(table(spark, data, "prices"), "symbol", "Date", ("Open", "High", "Low", "Close", "Volume"), 390)


@query(_probe_sql("prices_daily", ("Close", "Volume"), 1))
def coverage_daily(spark, data):
    return monitor.probe(table(spark, data, "prices_daily"), "symbol", "Date", ("Close", "Volume"), 1)


@query("""WITH e AS (SELECT p_brand AS endpoint, count(DISTINCT p_partkey) AS expected FROM part GROUP BY 1), w AS (SELECT p_brand AS endpoint, count(DISTINCT p_partkey) AS written FROM part WHERE p_size > 10 GROUP BY 1)
          SELECT coalesce(e.endpoint, w.endpoint) AS endpoint, coalesce(expected, 0) AS expected, coalesce(written, 0) AS written, CASE WHEN coalesce(expected, 0) > 0 THEN round(coalesce(written, 0) / expected, 4) END AS written_ratio FROM e FULL JOIN w ON e.endpoint = w.endpoint""")
def files_expected_ratio(spark, data):
    p = table(spark, data, "part")
    expected = p.select(F.col("p_brand").alias("endpoint"), F.col("p_partkey").cast("string").alias("symbol"))
    files = p.filter("p_size > 10").select(F.col("p_brand").alias("endpoint"), F.explode(F.array(*[F.concat(F.lit("stocks_"), F.col("p_partkey").cast("string"), F.lit(x)) for x in ("_annual.parquet", "_quarterly.parquet")])).alias("file"))
    return monitor.expected_ratio(expected, files.select("endpoint", expr.symbol_of_file("file").alias("symbol")), ["endpoint"])


@query("""WITH p AS (SELECT event_type, count(*) AS v FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'click' GROUP BY 1), c AS (SELECT event_type, count(*) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type <> 'error' GROUP BY 1)
          SELECT coalesce(p.event_type, c.event_type) AS event_type, p.v AS previous, c.v AS current, c.v - p.v AS delta FROM p FULL JOIN c ON p.event_type = c.event_type""")
def report_diff(spark, data):
    e = _events(spark, data)
    half = lambda test: e.filter(test).groupBy("event_type").agg(F.count("*").alias("v"))
    return monitor.metric_diff(half("day < '2024-01-15' AND event_type <> 'click'"), half("day >= '2024-01-15' AND event_type <> 'error'"), "event_type", "v")


@query(f"WITH {_CELLS_SQL} SELECT e.event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM ce WHERE NOT ok AND ce.symbol = e.user_id AND ce.endpoint = e.event_type)")
def skip_known_empty(spark, data):
    matrix = _cells(spark, data)[3]
    parts = [clean.known_empty(matrix, c) for c in _TYPES]
    cells = reduce(DataFrame.unionByName, parts).select(F.col("symbol").alias("user_id"), F.col("endpoint").alias("event_type"))
    return table(spark, data, "events").join(cells, ["user_id", "event_type"], "left_anti").select("event_id")


@query("SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) AS other_status FROM orders")
def status_rollup(spark, data):
    return monitor.status_rollup(table(spark, data, "orders"), "o_orderstatus", ("F", "O"))


@query("SELECT 'customer' AS catalog, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part")
def count_only(spark, data):
    return monitor.row_counts({n: table(spark, data, n) for n in ("customer", "supplier", "part")})


@query("SELECT o_orderpriority, round(avg(date_diff('day', DATE '2000-01-01', CAST(o_orderdate AS DATE))) FILTER (WHERE o_orderdate >= TIMESTAMP '2000-01-01'), 2) AS mean_days FROM orders GROUP BY 1")
def calendar_rollup(spark, data):
    return monitor.mean_days(table(spark, data, "orders"), "o_orderpriority", F.to_date("o_orderdate"), _day("2000-01-01"))


@query("""WITH h AS (SELECT l_orderkey AS fund, l_partkey AS symbol FROM lineitem), s AS (SELECT l_partkey AS symbol, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
          SELECT fund, count(*) AS holdings, count(s.n) AS covered, min(s.n) AS least_rows FROM h LEFT JOIN s USING (symbol) GROUP BY fund""")
def coverage_summary(spark, data):
    li = table(spark, data, "lineitem")
    stats = li.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).groupBy(F.col("l_partkey").alias("symbol")).agg(F.count("*").alias("n"))
    return monitor.fund_coverage(li.select(F.col("l_orderkey").alias("fund"), F.col("l_partkey").alias("symbol")), stats)


# -- nested data ------------------------------------------------------------------------


@query("""SELECT o_orderkey AS article, max(l_discount) FILTER (WHERE l_returnflag = 'A') AS topic_a, max(l_discount) FILTER (WHERE l_returnflag = 'N') AS topic_n, max(l_discount) FILTER (WHERE l_returnflag = 'R') AS topic_r
          FROM orders LEFT JOIN (SELECT l_orderkey, l_returnflag, arg_max(l_discount, (l_linenumber, l_discount)) AS l_discount FROM lineitem GROUP BY 1, 2) ON l_orderkey = o_orderkey GROUP BY 1""")
def topic_pivot(spark, data):
    topics = table(spark, data, "lineitem").groupBy(F.col("l_orderkey").alias("article")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_discount").alias("score"), F.col("l_returnflag").alias("topic")))).alias("topics"))
    a = table(spark, data, "orders").select(F.col("o_orderkey").alias("article")).join(topics, "article", "left")
    return a.select("article", *[expr.first_keyed(F.col("topics"), "topic", "score", t).alias(f"topic_{t.lower()}") for t in ("A", "N", "R")])


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1")
def json_props(spark, data):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, data, "events").groupBy(k.alias("k")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT user_id, 'timezone_mismatch' AS issue, count(*) AS n FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1""")
def tz_mismatch(spark, data):
    zone = F.when(F.col("event_type").isin("error", "signup"), "UTC").otherwise("US/Eastern")
    meta = F.create_map(F.lit("1. Information"), F.lit("x"), F.lit("6. Time Zone"), zone)
    events = table(spark, data, "events").select("user_id", clean.time_zone_issue(meta, "US/Eastern").alias("issue"))
    return events.filter("issue IS NOT NULL").groupBy("user_id", "issue").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'open;low' WHEN 'O' THEN 'low' END AS missing FROM orders WHERE o_orderstatus IN ('F', 'O')")
def required_keys(spark, data):
    having = lambda *keys: F.create_map(*[F.lit(x) for k in keys for x in (k, "1")])
    record = F.when(F.col("o_orderstatus") == "F", having("close")).when(F.col("o_orderstatus") == "O", having("open", "close")).otherwise(having("open", "low", "close"))
    return table(spark, data, "orders").select("o_orderkey", clean.missing_keys(record, ["open", "low", "close"]).alias("missing")).filter("missing IS NOT NULL")


# -- point in time ----------------------------------------------------------------------


@query("""SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30') WHERE rn = 1""")
def pit_asof(spark, data):
    o = table(spark, data, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice")
    return windows.known_on(o, ["o_custkey", "o_orderpriority"], "o_orderdate", F.lit("1998-06-30").cast("timestamp_ntz"), [F.col("o_orderkey").desc()]).drop("o_orderdate")


@query("""SELECT o_custkey, o_orderkey, old_value, o_orderstatus FROM (SELECT *, lag(o_orderstatus) OVER w AS old_value, row_number() OVER w AS rn FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE rn > 1 AND old_value IS DISTINCT FROM o_orderstatus""")
def restatements(spark, data):
    o = table(spark, data, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return windows.restatements(o, ["o_custkey"], "o_orderdate", "o_orderstatus", [F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "old_value", "o_orderstatus")
