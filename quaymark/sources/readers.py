"""Readers of raw deliveries: listing and bar CSVs, and the vendor's JSON bodies.

Every reader takes text as text (nothing is inferred) and casts leniently; what a cast
loses comes out of ``split_issues`` as issues. JSON bodies come as a table of
``symbol`` and ``body``, so parsing is one pass of built-in functions over all symbols.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.functions import expr
from quaymark.schemas import CALENDAR_CSV, COMMODITIES, INDICATORS, LISTING_CSV, TOPICS

#: Fixed value: what the vendor's notes say where a plan does not cover an endpoint; asking again is no use.
NOT_ENTITLED = "not yet entitled"
#: Field names of the vendor's bars.
BAR_FIELDS = {"Open": "1. open", "High": "2. high", "Low": "3. low", "Close": "4. close", "Volume": "5. volume"}
DAILY_FIELDS = {"Open": "1. open", "High": "2. high", "Low": "3. low", "Close": "4. close", "Volume": "6. volume", "DividendAmount": "7. dividend amount", "SplitCoefficient": "8. split coefficient"}


def optional(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, bool]:
    """The table at ``path`` and whether it was there; an empty one of ``schema`` if not."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return (spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)), there


def catalog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A catalog table; a missing one is an error."""
    df, there = optional(spark, path, schema)
    if not there:
        raise FileNotFoundError(path)
    return df


def tolerant(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files of which broken or vanished ones are passed over."""
    return spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(path)


def file_status(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``file``, ``n_rows`` and ``status`` (``ok``, ``empty`` or ``unreadable``) of every file of a folder of Parquet files."""
    listed = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "length")
    rows = tolerant(spark, path, schema).select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count("*").alias("n_rows"))
    # a Parquet file starts and ends with its mark; content is read for files without rows only
    whole = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content").join(F.broadcast(rows.select("file")), "file", "left_anti")
    marked = whole.select("file", (F.expr("substring(content, -4, 4)") == F.lit(b"PAR1")).alias("sound"))
    status = F.when(F.col("n_rows").isNotNull(), "ok").when(F.col("sound"), "empty").otherwise("unreadable")
    return listed.select("file").join(rows, "file", "left").join(marked, "file", "left").select("file", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), status.alias("status"))


def text_csv(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """A CSV with header, all text, header names trimmed."""
    df = spark.read.options(header="true", inferSchema="false", **options).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def daily_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Daily bars of a second vendor; the symbol comes from the file name, an unreadable date is null."""
    raw = spark.read.options(header="true", inferSchema="false").csv(path).select("*", "_metadata.file_name")
    df = raw.toDF(*[c.strip() for c in raw.columns])
    symbol = F.url_decode(F.url_decode(F.regexp_extract("file_name", r"^(.+)_[^_]*\.csv$", 1)))
    named = lambda c: c.lower() if c.lower() in df.columns else c
    numbers = [expr.number(named(c)).cast("float").alias(c) for c in ("Open", "High", "Low", "Close", "Volume")]
    return df.select(symbol.alias("symbol"), expr.lax_date(named("Date")).alias("Date"), *numbers)


def located(symbols: DataFrame, files: DataFrame) -> DataFrame:
    """Each symbol with its file, null where there is none; of several files of a symbol the first by name. ``files`` has ``file`` (names)."""
    named = files.select(F.url_decode(F.regexp_extract("file", r"^(.+)_[^_]*\.csv$", 1)).alias("symbol"), "file").groupBy("symbol").agg(F.min("file").alias("file"))
    return symbols.select("symbol").join(named, "symbol", "left")


def check_headers(tables: Mapping[str, DataFrame], required: Sequence[str]) -> None:
    """Raises one error that names every table and the columns it lacks."""
    lacking = {name: missing_columns(df, required) for name, df in tables.items()}
    wrong = [f"{name}: {', '.join(cols)}" for name, cols in lacking.items() if cols]
    if wrong:
        raise ValueError("missing columns in " + "; ".join(wrong))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def listings(spark: SparkSession, active: str, delisted: str) -> DataFrame:
    """Active and delisted listing as one table; ``src_rank`` keeps their order, the text ``null`` is null."""
    read = lambda path, rank: spark.read.schema(LISTING_CSV).options(header="true", nullValue="null").csv(path).withColumn("src_rank", F.lit(rank))
    return read(active, 0).unionByName(read(delisted, 1)).withColumns({c: F.col(c).try_cast("date") for c in ("ipoDate", "delistingDate")})


def vendor_catalog(df: DataFrame, names: Mapping[str, str], sectors: Mapping[str, str] | None = None) -> DataFrame:
    """A second vendor's catalog under our names; columns it lacks are null, sectors normalised, dates lenient."""
    have = {ours: (F.col(f"`{theirs}`") if theirs in df.columns else F.lit(None).cast("string")) for ours, theirs in names.items()}
    for c in ("ipoDate", "delistingDate"):
        have[c] = have.get(c, F.lit(None).cast("string")).try_cast("date")
    if sectors is not None and "sector" in have:
        have["sector"] = expr.normalised(have["sector"], sectors)
    return df.select(*[v.alias(k) for k, v in have.items()])


def minute_csv(spark: SparkSession, path: str) -> DataFrame:
    """1-minute bars of a second vendor; the symbol comes from the file name, rows without readable stamp are null there."""
    raw = spark.read.options(header="true", inferSchema="false").csv(path).select("*", "_metadata.file_name")
    df = raw.toDF(*[c.strip() for c in raw.columns])
    # Spark gives the name as part of a URI, inside which is our own encoding
    symbol = F.url_decode(F.url_decode(F.regexp_extract("file_name", r"^(.+)_[^_]*\.csv$", 1)))
    numbers = [expr.number(c.lower() if c.lower() in df.columns else c).cast("float").alias(c) for c in ("Open", "High", "Low", "Close", "Volume")]
    return df.select(symbol.alias("symbol"), F.try_to_timestamp(F.col("timestamp"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("Date"), *numbers)


def earnings_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Global earnings calendar with the columns whose cast failed listed in ``cast_issues``."""
    raw = spark.read.schema(CALENDAR_CSV).option("header", "true").csv(path)
    reported, fiscal, estimate = expr.lax_date("reportDate"), expr.lax_date("fiscalDateEnding"), expr.number("estimate")
    had = lambda c: expr.without_sentinels(c).isNotNull()
    issues = expr.issue_list([("reportedDate", had("reportDate") & reported.isNull()), ("fiscalDateEnding", had("fiscalDateEnding") & fiscal.isNull()), ("estimate", had("estimate") & estimate.isNull())])
    return raw.select("symbol", "name", reported.alias("reportedDate"), fiscal.alias("fiscalDateEnding"), estimate.alias("estimate"), "currency", "timeOfTheDay", issues.alias("cast_issues"))


def body_class(body: Column) -> Column:
    """``av_throttle``, ``entitlement``, ``structure_error`` or null for a usable body."""
    parsed = F.from_json(body, "map<string,string>")
    note = F.coalesce(F.element_at(parsed, "Note"), F.element_at(parsed, "Information"))
    return (
        F.when(parsed.isNull(), "structure_error")
        .when(F.lower(note).contains(NOT_ENTITLED), "entitlement")
        .when(note.isNotNull(), "av_throttle")
        .when(F.map_contains_key(parsed, "Error Message"), "structure_error")
    )


def series(bodies: DataFrame, key: str, fields: Mapping[str, str], date_type: str) -> DataFrame:
    """One row per symbol and date of a series object ``{key: {date: {field: value}}}``.

    Values stay text under our names; ``payload`` is the number of fields, 0 for an empty bar.
    Bodies without the series give nothing.
    """
    parsed = F.from_json(F.get_json_object("body", f"$['{key}']"), "map<string,map<string,string>>")
    rows = bodies.select("symbol", F.explode(parsed).alias("raw_date", "bar"))
    values = [F.element_at("bar", theirs).alias(ours) for ours, theirs in fields.items()]
    return rows.select("symbol", "raw_date", F.col("raw_date").try_cast(date_type).alias("Date"), F.coalesce(F.size("bar"), F.lit(0)).alias("payload"), *values)


def split_issues(rows: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(clean, issues) of text rows: a row with an empty bar or a value that is no number is dropped and named."""
    cast = rows.withColumns({f"n_{v}": expr.number(v) for v in values})
    ok = (F.col("payload") > 0) & F.col("Date").isNotNull()
    for v in values:
        ok = ok & F.col(f"n_{v}").isNotNull()
    clean = cast.filter(ok).select("symbol", "Date", *[F.col(f"n_{v}").cast("float").alias(v) for v in values])
    kind = F.when(F.col("payload") == 0, "empty_content").otherwise("cast_failure")
    issues = cast.filter(~F.coalesce(ok, F.lit(False))).select("symbol", kind.alias("issue_type"), F.concat(F.lit("row "), "raw_date").alias("detail"))
    return clean, issues


def drop_recovered(issues: DataFrame, rows: DataFrame) -> DataFrame:
    """Issues without the structure errors of symbols that got rows after all."""
    hard = issues.filter("issue_type = 'structure_error'").join(rows.select("symbol"), "symbol", "left_anti")
    return issues.filter("issue_type <> 'structure_error'").unionByName(hard)


#: Keys of the daily series of currencies and their fields; they have no volume.
FOREX_KEY = "Time Series FX (Daily)"
FOREX_FIELDS = {k: BAR_FIELDS[k] for k in ("Open", "High", "Low", "Close")}


def forex(bodies: DataFrame) -> DataFrame:
    """Daily rows of currency pairs as from ``series``, with ``from_currency`` and ``to_currency``; the dollar against itself is left out."""
    rows = series(bodies.filter("symbol <> 'USDUSD'"), FOREX_KEY, FOREX_FIELDS, "date")
    return rows.withColumns({"from_currency": F.substring("symbol", 1, 3), "to_currency": F.substring("symbol", 4, 3)})


def index_series(bodies: DataFrame) -> DataFrame:
    """Daily rows of ``{"data": [{"date", "open", "high", "low", "close"}]}`` bodies; sentinels and what is no number are null, rows without date are dropped."""
    fields = ("open", "high", "low", "close")
    rows = bodies.select("symbol", F.inline(F.from_json(F.get_json_object("body", "$.data"), "array<struct<" + ",".join(f"{c}:string" for c in ("date", *fields)) + ">>")))
    numbers = [expr.number(expr.without_sentinels(c)).cast("float").alias(c.capitalize()) for c in fields]
    return rows.select("symbol", F.col("date").try_cast("date").alias("Date"), *numbers).filter("Date IS NOT NULL")


def points(bodies: DataFrame, value: str, unit: Column | None = None) -> DataFrame:
    """Date and value of ``{"data": [{"date", value}]}`` bodies; sentinels are null, other bad values drop the row."""
    parsed = F.from_json("body", f"struct<unit:string,data:array<struct<date:string,{value}:string>>>")
    rows = bodies.select("symbol", parsed.alias("p")).select("symbol", F.col("p.unit").alias("unit"), F.inline("p.data"))
    raw = expr.without_sentinels(value)
    out = rows.select("symbol", F.col("date").try_cast("date").alias("Date"), raw.alias("raw"), expr.number(raw).alias("value"), (F.col("unit") if unit is None else unit).alias("unit"))
    return out.filter("Date IS NOT NULL AND (raw IS NULL OR value IS NOT NULL)").drop("raw")


def reports(bodies: DataFrame, annual: str, quarterly: str, texts: Sequence[str] = ("reportedCurrency", "reportTime")) -> DataFrame:
    """Annual and quarterly reports of fundamentals: ``symbol``, ``period``, ``fiscalDateEnding``, texts, and all numbers as a map.

    Columns differ from vendor to vendor and year to year, so numbers stay under the
    vendor's names in ``values``; sentinels are null and what is no number is left out.
    """
    kind = "array<map<string,string>>"

    def labelled(period: str, key: str) -> Column:
        entries = F.coalesce(F.from_json(F.get_json_object("body", f"$.{key}"), kind), F.array())
        return F.transform(entries, lambda m: F.struct(F.lit(period).alias("period"), m.alias("m")))

    parts = [labelled("annual", annual), labelled("quarterly", quarterly)]
    rows = bodies.select("symbol", F.inline(F.concat(*parts)))
    fixed = ("fiscalDateEnding", "reportedDate", *texts)
    numbers = F.map_filter(F.transform_values(F.map_filter("m", lambda k, v: ~k.isin(*fixed)), lambda k, v: expr.number(v).cast("float")), lambda k, v: v.isNotNull())
    return rows.select(
        "symbol", "period", expr.lax_date(F.element_at("m", "fiscalDateEnding")).alias("fiscalDateEnding"), expr.lax_date(F.element_at("m", "reportedDate")).alias("reportedDate"),
        *[expr.without_sentinels(F.element_at("m", t)).alias(t) for t in texts], numbers.alias("values"),
    )


def typed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``reports``, ``estimates`` or ``insider_trades`` as stored: the numbers of the map as float columns, null where a row lacks them."""
    return rows.select(*[c for c in rows.columns if c != "values"], *[F.element_at("values", c).alias(c) for c in columns])


def news_issues(pages: DataFrame) -> DataFrame:
    """One issue per article whose time is unreadable; ``news`` passes over them."""
    a = pages.select(F.inline(F.from_json(F.get_json_object("body", "$.feed"), "array<struct<time_published:string,url:string>>")))
    bad = a.filter(expr.news_stamp("time_published").isNull())
    return bad.select(F.lit("GLOBAL").alias("symbol"), F.lit("cast_failure").alias("issue_type"), F.concat(F.lit("time_published "), F.coalesce("time_published", F.lit("missing"))).alias("detail"), "url")


def news(pages: DataFrame) -> DataFrame:
    """One row per article and ticker of news pages, topics in their fixed columns (the last of a repeated topic wins).

    Articles without ticker or with an unreadable time give nothing.
    """
    ticker = "struct<ticker:string,relevance_score:string,ticker_sentiment_score:string,ticker_sentiment_label:string>"
    texts = ("title", "url", "summary", "banner_image", "source", "category_within_source", "source_domain", "overall_sentiment_label")
    article = "struct<time_published:string,authors:array<string>,overall_sentiment_score:string," + ",".join(f"{t}:string" for t in texts) + f",topics:array<struct<topic:string,relevance_score:string>>,ticker_sentiment:array<{ticker}>>"
    a = pages.select(F.inline(F.from_json(F.get_json_object("body", "$.feed"), f"array<{article}>")))
    a = a.withColumn("time_published", expr.news_stamp("time_published")).filter("time_published IS NOT NULL")
    wide = [expr.number(expr.first_keyed(F.col("topics"), "topic", "relevance_score", t)).cast("float").alias(t) for t in TOPICS]
    one = a.select("*", F.inline("ticker_sentiment"))
    num = lambda c: expr.number(c).cast("float").alias(c)
    return one.select(
        "time_published", "ticker", num("relevance_score").alias("ticker_relevance_score"), num("ticker_sentiment_score"), "ticker_sentiment_label",
        *texts, F.coalesce(F.array_join("authors", ";"), F.lit("")).alias("authors"), num("overall_sentiment_score"), *wide,
    )


def fund_profiles(bodies: DataFrame, sectors: Mapping[str, str]) -> DataFrame:
    """Fund profile with sector weights in columns, unmapped sectors summed into ``other``, and holdings as an array.

    The last of a repeated mapped sector wins; holdings of sentinel symbols are dropped,
    and no holdings at all are null.
    """
    weight = "array<struct<{}:string,weight:string>>"
    p = F.from_json("body", f"struct<net_assets:string,net_expense_ratio:string,portfolio_turnover:string,dividend_yield:string,inception_date:string,leveraged:string,sectors:{weight.format('sector')},holdings:{weight.format('symbol')}>")
    rows = bodies.select("symbol", p.alias("p")).select("symbol", "p.*")
    clean = lambda c: expr.without_sentinels(c, expr.FUND_SENTINELS)
    mapped = [expr.number(expr.first_keyed(F.col("sectors"), "sector", "weight", theirs)).cast("float").alias(ours) for theirs, ours in sectors.items()]
    rest = F.filter(F.transform(F.filter("sectors", lambda s: ~s["sector"].isin(*sectors)), lambda s: expr.number(s["weight"])), lambda w: w.isNotNull())
    other = F.when(F.size(rest) > 0, F.aggregate(rest, F.lit(0.0), lambda a, w: a + w)).cast("float")
    held = F.transform(F.filter("holdings", lambda h: clean(h["symbol"]).isNotNull()), lambda h: F.struct(h["symbol"].alias("symbol"), expr.number(h["weight"]).cast("float").alias("weight")))
    numbers = [expr.number(clean(c)).cast("float").alias(c) for c in ("net_assets", "net_expense_ratio", "portfolio_turnover", "dividend_yield")]
    return rows.select("symbol", *mapped, other.alias("other"), F.when(F.size(held) > 0, held).alias("holdings"), *numbers, clean("inception_date").alias("inception_date"), clean("leveraged").alias("leveraged"))


def currency_pairs(codes: DataFrame) -> DataFrame:
    """Currency list to pairs against the dollar, the dollar itself left out."""
    return codes.filter("`currency code` <> 'USD'").select(F.concat("currency code", F.lit("USD")).alias("symbol"), F.concat("currency name", F.lit(" to US Dollar")).alias("name"))


def crypto_catalog(codes: DataFrame, market: str = "USD") -> DataFrame:
    """Symbols of one market of a list of ``from_currency`` and ``to_currency``, with a name made of both."""
    name = F.concat(F.lit("Cryptocurrency "), F.col("from_currency"), F.lit(" for Market "), F.col("to_currency"))
    return codes.filter(F.col("to_currency") == market).select(F.col("from_currency").alias("symbol"), name.alias("name"))


def index_catalog(bodies: DataFrame) -> DataFrame:
    """Symbols and names of an object keyed by symbol."""
    return bodies.select(F.explode(F.from_json("body", "map<string,string>")).alias("symbol", "name"))


def estimates(bodies: DataFrame) -> DataFrame:
    """Estimates by ``period`` from their horizon, numbers as a map; other horizons are left out."""
    m = F.explode(F.from_json(F.get_json_object("body", "$.estimates"), "array<map<string,string>>"))
    rows = bodies.select("symbol", m.alias("m"))
    horizon = F.element_at("m", "horizon")
    numbers = F.transform_values(F.map_filter("m", lambda k, v: ~k.isin("date", "horizon")), lambda k, v: expr.number(v).cast("float"))
    period = F.when(horizon == "fiscal year", "annual").when(horizon == "fiscal quarter", "quarterly")
    return rows.select("symbol", period.alias("period"), expr.lax_date(F.element_at("m", "date")).alias("fiscalDateEnding"), F.map_filter(numbers, lambda k, v: v.isNotNull()).alias("values")).filter("period IS NOT NULL")


def insider_trades(bodies: DataFrame) -> DataFrame:
    """Insider transactions: date, the text columns, every other value as a number in a map."""
    texts = ("executive", "executive_title", "security_type", "acquisition_or_disposal")
    rows = bodies.select("symbol", F.explode(F.from_json(F.get_json_object("body", "$.data"), "array<map<string,string>>")).alias("m"))
    numbers = F.transform_values(F.map_filter("m", lambda k, v: ~k.isin("ticker", "transaction_date", *texts)), lambda k, v: expr.number(v).cast("float"))
    return rows.select(
        "symbol", expr.lax_date(F.element_at("m", "transaction_date")).alias("transactionDate"), *[expr.without_sentinels(F.element_at("m", t)).alias(t) for t in texts],
        F.map_filter(numbers, lambda k, v: v.isNotNull()).alias("values"),
    )


def static_catalog(spark: SparkSession, kind: str) -> DataFrame:
    """The fixed catalogs of commodities and economic indicators, all Active."""
    entries = [(symbol, name, "Active") for symbol, name, *_ in {"commodities": COMMODITIES, "economic": INDICATORS}[kind]]
    return spark.createDataFrame(entries, "symbol string, name string, status string")


def with_commodity_class(df: DataFrame) -> DataFrame:
    """``df`` with the class of its commodity symbols, ``structure_error`` for unknown ones; 13 fixed rows are broadcast."""
    dim = df.sparkSession.createDataFrame([(symbol, kind) for symbol, _, kind in COMMODITIES], "symbol string, class string")
    return df.join(F.broadcast(dim), "symbol", "left").fillna("structure_error", ["class"])


def indicator_config(spark: SparkSession) -> DataFrame:
    """Vendor function and parameters per indicator: 15 fixed rows."""
    return spark.createDataFrame([(s, f, i, m) for s, _, f, i, m in INDICATORS], "symbol string, function string, interval string, maturity string")
