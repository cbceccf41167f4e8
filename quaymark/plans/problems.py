"""Queries of the data problems that belong to the core, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.functions.stamps import with_instant
from quaymark.functions.text import canonical_symbol, canonical_url
from quaymark.operators import dedupe, grid, snapshots, spikes
from quaymark.sources.tables import table

STOCK_ATTRIBUTES = ("name", "sector", "ipoDate", "delistingDate", "status")
ETF_ATTRIBUTES = ("name", "ipoDate", "delistingDate", "status")
VERSION_ATTRIBUTES = ("name", "sector", "delistingDate", "status")


def p1_found(spark: SparkSession, data: str) -> DataFrame:
    return snapshots.found_changes({"stocks": (table(spark, data, "stocks"), STOCK_ATTRIBUTES), "etfs": (table(spark, data, "etfs"), ETF_ATTRIBUTES)})


def p2_grid(spark: SparkSession, data: str) -> DataFrame:
    return grid.minute_grid(table(spark, data, "prices"))


def p2_found(spark: SparkSession, data: str) -> DataFrame:
    return p2_grid(spark, data).filter("filled").select("symbol", "minute")


def p3_found(spark: SparkSession, data: str) -> DataFrame:
    return spikes.implausible_readings(table(spark, data, "prices_daily"), table(spark, data, "prices"))


def p5_found(spark: SparkSession, data: str) -> DataFrame:
    s, i, p = table(spark, data, "sentiment"), table(spark, data, "ingestion_report"), table(spark, data, "prices_raw")
    rows = (
        s.select(F.lit("sentiment").alias("src"), "rec_id", F.col("time_published").alias("stamp"), F.lit("UTC").alias("zone"))
        .unionByName(i.select(F.lit("ingestion_report").alias("src"), "rec_id", F.col("timestamp").alias("stamp"), F.coalesce("host_zone", F.lit("UTC")).alias("zone")))
        .unionByName(p.select(F.lit("prices_raw").alias("src"), "rec_id", F.col("Date").alias("stamp"), F.coalesce("time_zone", F.lit("US/Eastern")).alias("zone")))
    )
    return with_instant(rows, "stamp", F.col("zone")).select("src", "rec_id", "epoch_us").filter("epoch_us IS NOT NULL")


def p6_history(spark: SparkSession, data: str) -> DataFrame:
    return snapshots.history(table(spark, data, "stocks"), VERSION_ATTRIBUTES)


def p6_found(spark: SparkSession, data: str) -> DataFrame:
    text = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return p6_history(spark, data).select("symbol", text("valid_from"), text("valid_to"))


def p7_found(spark: SparkSession, data: str) -> DataFrame:
    m = table(spark, data, "all_messages").select("msg_id", "url", "ticker", "time_published")
    url = canonical_url("url")
    ident = F.when(url.isNotNull(), dedupe.identifier(url, F.upper(F.trim("ticker")), F.col("time_published")))
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dedupe.duplicates(m, ident, F.col("msg_id"), shards).select(F.col("arrival").alias("msg_id"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_grid, p3_found, p5_found, p6_found, p6_history, p7_found)}

#: Lower-cased text without blanks around it, null spellings as null.
_CANON = "nullif(nullif(nullif(nullif(lower(trim({0}, ' ' || chr(9))), ''), 'none'), '.'), 'null')"


def _standing(source: str, attributes: tuple[str, ...], texts: tuple[str, ...], spelled: bool = False) -> str:
    canon = ", ".join(f"{_CANON.format(a)} AS {a}" if a in texts else a for a in attributes)
    if spelled:  # as written beside the canonical form
        canon += "".join(f", CASE WHEN {_CANON.format(a)} IS NOT NULL THEN trim({a}, ' ' || chr(9)) END AS w_{a}" for a in texts)
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT snapshot_date, upper({_CANON.format('symbol')}) AS symbol, {canon}, "
        f"row_number() OVER (PARTITION BY snapshot_date, upper({_CANON.format('symbol')}) ORDER BY loaded_at DESC NULLS LAST) AS rn FROM {source} "
        f"WHERE {_CANON.format('symbol')} IS NOT NULL AND snapshot_date IS NOT NULL) WHERE rn = 1"
    )


def _changes_sql(kind: str, attributes: tuple[str, ...]) -> str:
    differs = " OR ".join(f"n.{a} IS DISTINCT FROM o.{a}" for a in attributes)
    return f"""
    SELECT '{kind}' AS asset_type, strftime(d.snapshot_date, '%Y-%m-%d') AS snapshot_date, n.symbol,
           CASE WHEN o.symbol IS NULL THEN 'added' ELSE 'changed' END AS change
    FROM {kind}_rows n JOIN {kind}_days d ON n.snapshot_date = d.snapshot_date AND d.prev IS NOT NULL
    LEFT JOIN {kind}_rows o ON o.snapshot_date = d.prev AND o.symbol = n.symbol WHERE o.symbol IS NULL OR {differs}
    UNION ALL
    SELECT '{kind}', strftime(d.snapshot_date, '%Y-%m-%d'), o.symbol, 'removed'
    FROM {kind}_rows o JOIN {kind}_days d ON o.snapshot_date = d.prev
    WHERE NOT EXISTS (SELECT 1 FROM {kind}_rows n WHERE n.snapshot_date = d.snapshot_date AND n.symbol = o.symbol)"""


_DAYS = "SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS prev, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS next, row_number() OVER (ORDER BY snapshot_date) AS no FROM (SELECT DISTINCT snapshot_date FROM {0}_rows)"

SQL = {
    "p1_found": f"""
    WITH stocks_rows AS ({_standing('stocks', STOCK_ATTRIBUTES, ('name', 'sector', 'status'))}), etfs_rows AS ({_standing('etfs', ETF_ATTRIBUTES, ('name', 'status'))}),
         stocks_days AS ({_DAYS.format('stocks')}), etfs_days AS ({_DAYS.format('etfs')})
    {_changes_sql('stocks', STOCK_ATTRIBUTES)} UNION ALL {_changes_sql('etfs', ETF_ATTRIBUTES)}""",
    "p2_found": """
    WITH m AS (SELECT DISTINCT symbol, date_trunc('minute', Date) AS minute FROM prices WHERE symbol IS NOT NULL AND Date IS NOT NULL AND Close IS NOT NULL AND NOT isnan(Close)),
         days AS (SELECT symbol, unnest(generate_series(min(minute), max(minute), INTERVAL 1 MINUTE)) AS minute FROM m GROUP BY symbol, CAST(minute AS DATE))
    SELECT symbol, strftime(minute, '%Y-%m-%d %H:%M') AS minute FROM days ANTI JOIN m USING (symbol, minute)""",
    "p6_found": f"""
    WITH stocks_rows AS ({_standing('stocks', VERSION_ATTRIBUTES, ('name', 'sector', 'status'))}), stocks_days AS ({_DAYS.format('stocks')}),
         r AS (SELECT r.*, d.no, d.next, CASE WHEN lag(d.no) OVER w = d.no - 1 {' '.join(f'AND lag({a}) OVER w IS NOT DISTINCT FROM {a}' for a in VERSION_ATTRIBUTES)} THEN 0 ELSE 1 END AS starts
               FROM stocks_rows r JOIN stocks_days d USING (snapshot_date) WINDOW w AS (PARTITION BY symbol ORDER BY d.no)),
         v AS (SELECT *, sum(starts) OVER (PARTITION BY symbol ORDER BY no) AS run FROM r)
    SELECT symbol, strftime(min(snapshot_date), '%Y-%m-%d') AS valid_from, coalesce(strftime(arg_max(coalesce(next, DATE '9999-12-31'), no), '%Y-%m-%d')) AS valid_to FROM v GROUP BY symbol, run""",
    "p6_history": f"""
    WITH stocks_rows AS ({_standing('stocks', VERSION_ATTRIBUTES, ('name', 'sector', 'status'), spelled=True)}), stocks_days AS ({_DAYS.format('stocks')}),
         r AS (SELECT r.*, d.no, d.next, CASE WHEN lag(d.no) OVER w = d.no - 1 {' '.join(f'AND lag({a}) OVER w IS NOT DISTINCT FROM {a}' for a in VERSION_ATTRIBUTES)} THEN 0 ELSE 1 END AS starts
               FROM stocks_rows r JOIN stocks_days d USING (snapshot_date) WINDOW w AS (PARTITION BY symbol ORDER BY d.no)),
         v AS (SELECT *, sum(starts) OVER (PARTITION BY symbol ORDER BY no) AS run FROM r)
    SELECT symbol, arg_min(w_name, no) FILTER (WHERE w_name IS NOT NULL) AS name, arg_min(w_sector, no) FILTER (WHERE w_sector IS NOT NULL) AS sector, any_value(delistingDate) AS delistingDate,
           arg_min(w_status, no) FILTER (WHERE w_status IS NOT NULL) AS status, min(snapshot_date) AS valid_from, arg_max(coalesce(next, DATE '9999-12-31'), no) AS valid_to FROM v GROUP BY symbol, run""",
    "p7_found": """
    WITH m AS (SELECT msg_id, nullif(regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '/$', ''), '') AS u, upper(trim(ticker)) AS t, time_published AS tp FROM all_messages)
    SELECT msg_id FROM (SELECT msg_id, u, min(msg_id) OVER (PARTITION BY u, t, tp) AS lowest FROM m WHERE u IS NOT NULL) WHERE msg_id > lowest""",
    "p5_found": r"""
    WITH r AS (SELECT 'sentiment' AS src, rec_id, time_published AS raw, 'UTC' AS zone FROM sentiment
               UNION ALL SELECT 'ingestion_report', rec_id, "timestamp", coalesce(host_zone, 'UTC') FROM ingestion_report
               UNION ALL SELECT 'prices_raw', rec_id, Date, coalesce(time_zone, 'US/Eastern') FROM prices_raw),
         x AS (SELECT src, rec_id, zone, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS t FROM r),
         z AS (SELECT *, CASE WHEN regexp_matches(t, '\d:\d\d|\dT\d{4}') THEN regexp_extract(t, '(\[[A-Za-z_]+/[A-Za-z_]+\]| ?[A-Z][A-Za-z]+/[A-Za-z_]+| ?[+-]\d{2}:?\d{2}| ?[+-]\d{2}|[Zz]| [A-Z]{3,4})$') ELSE '' END AS tail FROM x),
         b AS (SELECT *, upper(trim(tail)) AS mark, regexp_replace(regexp_replace(trim(left(t, length(t) - length(tail))), '(\d),(\d{3,6})$', '\1.\2'), '([ap])m$', CASE WHEN right(trim(left(t, length(t) - length(tail))), 2) = 'am' THEN 'AM' ELSE 'PM' END) AS body FROM z),
         l AS (SELECT *, try_strptime(body, ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M', '%Y-%m-%d', '%Y%m%dT%H%M%S', '%Y%m%dT%H%M',
                 '%d.%m.%Y %H:%M', '%m/%d/%Y %I:%M:%S %p', '%d-%b-%Y %H:%M:%S', '%a, %d %b %Y %H:%M:%S', '%b %d, %Y %I:%M:%S %p']) AS wall,
               CASE WHEN mark = '' THEN zone WHEN contains(mark, '/') THEN trim(translate(tail, '[]', '')) END AS region,
               CASE WHEN mark[1] IN ('+', '-') THEN (CASE mark[1] WHEN '-' THEN -1 ELSE 1 END) * (CAST(mark[2:3] AS INTEGER) * 60 + coalesce(TRY_CAST(right(mark, length(mark) - 3 - CAST(contains(mark, ':') AS INTEGER)) AS INTEGER), 0))
                    ELSE CASE mark WHEN 'Z' THEN 0 WHEN 'UTC' THEN 0 WHEN 'GMT' THEN 0 WHEN 'WET' THEN 0 WHEN 'BST' THEN 60 WHEN 'CET' THEN 60 WHEN 'CEST' THEN 120 WHEN 'JST' THEN 540
                              WHEN 'EST' THEN -300 WHEN 'EDT' THEN -240 WHEN 'CST' THEN -360 WHEN 'CDT' THEN -300 WHEN 'MST' THEN -420 WHEN 'MDT' THEN -360 WHEN 'PST' THEN -480 WHEN 'PDT' THEN -420 END END AS minutes FROM b),
         i AS (SELECT *, CASE WHEN region IS NOT NULL AND wall IS NOT NULL THEN timezone(region, wall) END AS late FROM l),
         e AS (SELECT src, rec_id, CASE WHEN regexp_full_match(t, '\d+') THEN CASE WHEN length(t) <= 11 THEN CAST(t AS BIGINT) * 1000000 WHEN length(t) <= 14 THEN CAST(t AS BIGINT) * 1000 WHEN length(t) <= 17 THEN CAST(t AS BIGINT) END
                      WHEN region IS NOT NULL THEN epoch_us(CASE WHEN timezone(region, late - INTERVAL 1 HOUR) = wall THEN late - INTERVAL 1 HOUR ELSE late END)
                      ELSE epoch_us(wall) - CAST(minutes AS BIGINT) * 60000000 END AS epoch_us FROM i)
    SELECT src, rec_id, epoch_us FROM e WHERE epoch_us IS NOT NULL""",
}
