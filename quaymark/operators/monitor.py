"""Roll-ups, probes and differences of a run's figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.functions.expr import ratio


def issue_rollup(issues: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts per combination, per first column and in total, in one rollup; totals are named ALL."""
    rolled = issues.rollup(*by).agg(F.count("*").alias("n"))
    return rolled.select(*[F.coalesce(c, F.lit("ALL")).alias(c) for c in by], "n")


def status_rollup(df: DataFrame, status: str, known: Sequence[str]) -> DataFrame:
    """One row: ``total``, a count per known status in lower case, and ``other_status`` for the rest, null included."""
    s = F.col(status)
    return df.agg(F.count("*").alias("total"), *[F.count_if(s == k).alias(k.lower()) for k in known], F.count_if(~F.coalesce(s.isin(*known), F.lit(False))).alias("other_status"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``catalog`` and ``n`` of every table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("catalog"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def mean_days(df: DataFrame, by: str, day: Column, today: Column, digits: int = 2) -> DataFrame:
    """Mean days from ``today`` to the days that are not past, per ``by``."""
    return df.groupBy(by).agg(F.round(F.avg(F.when(day >= today, F.datediff(day, today))), digits).alias("mean_days"))


def fund_coverage(holdings: DataFrame, stats: DataFrame) -> DataFrame:
    """Per fund its holdings, how many of them have figures, and the fewest rows among those. ``holdings`` has ``fund`` and ``symbol``, ``stats`` ``symbol`` and ``n``."""
    return holdings.join(stats, "symbol", "left").groupBy("fund").agg(F.count("*").alias("holdings"), F.count("n").alias("covered"), F.min("n").alias("least_rows"))


def file_digests(spark, path: str) -> DataFrame:
    """``file``, ``bytes`` and ``md5`` of the files of a folder: what ``tree_diff`` compares."""
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("length").alias("bytes"), F.md5("content").alias("md5"))


def probe(series: DataFrame, key: str, day: str, values: Sequence[str], least_rows: int, most_null: float = 0.01) -> DataFrame:
    """Rows, last day and share of nulls per key, and why a series fails, reasons joined by ``; ``."""
    a = series.groupBy(key).agg(F.count("*").alias("n_rows"), F.max(day).alias("last"), *[F.round(F.count_if(F.col(v).isNull()) / F.count("*"), 6).alias(f"null_{v}") for v in values])
    few = F.when(F.col("n_rows") < least_rows, F.lit(f"rows below {least_rows}"))
    sparse = [F.when(F.col(f"null_{v}") >= most_null, F.lit(f"{v} has nulls")) for v in values]
    return a.withColumn("reasons", F.concat_ws("; ", few, *sparse)).withColumn("ok", F.col("reasons") == "")


def metric_diff(previous: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """Signed difference per metric; null when either side lacks it."""
    p, c = previous.select(key, F.col(value).alias("previous")), current.select(key, F.col(value).alias("current"))
    return p.join(c, key, "full_outer").withColumn("delta", F.col("current") - F.col("previous"))


def expected_ratio(expected: DataFrame, written: DataFrame, by: Sequence[str]) -> DataFrame:
    """Symbols written against symbols expected; the ratio is null where none is expected."""
    j = expected.groupBy(*by).agg(F.countDistinct("symbol").alias("expected")).join(written.groupBy(*by).agg(F.countDistinct("symbol").alias("written")), list(by), "full_outer")
    filled = j.fillna(0, ["expected", "written"])
    return filled.withColumn("written_ratio", F.when(F.col("expected") > 0, ratio(F.col("written"), F.col("expected"), 4)))


def tree_diff(local: DataFrame, remote: DataFrame, key: str, digest: str) -> DataFrame:
    """Class of every file: only on one side, or different on both; equal files don't come out."""
    a, b = local.select(key, F.col(digest).alias("l")), remote.select(key, F.col(digest).alias("r"))
    kind: Column = F.when(F.col("r").isNull(), "local_only").when(F.col("l").isNull(), "remote_only").when(F.col("l") != F.col("r"), "differs")
    return a.join(b, key, "full_outer").select(key, kind.alias("class")).filter("class IS NOT NULL")
