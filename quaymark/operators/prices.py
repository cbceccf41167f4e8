"""Split and dividend events from three variants of a daily series, and the inverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def corporate_actions(raw: DataFrame, split_adjusted: DataFrame, fully_adjusted: DataFrame, digits: int = 6) -> DataFrame:
    """``SplitCoefficient`` and ``DividendAmount`` per symbol and Date, from dates in all three variants.

    The cumulative split factor is Close over the split-adjusted close; its step down is
    the day's split. The ratio of the two adjusted closes steps by the dividend factor.
    First days and steps beside a null or zero close give 1 and 0.
    """
    k = ["symbol", "Date"]
    j = (
        raw.select(*k, F.col("Close").cast("double").alias("c"))
        .join(split_adjusted.select(*k, F.col("Close").cast("double").alias("sa")), k)
        .join(fully_adjusted.select(*k, F.col("Close").cast("double").alias("sda")), k)
    )
    w = Window.partitionBy("symbol").orderBy("Date")
    s = j.withColumns({"cum": F.try_divide("c", "sa"), "ratio": F.try_divide("sda", "sa")})
    s = s.withColumns({"p_cum": F.lag("cum").over(w), "p_ratio": F.lag("ratio").over(w), "p_sa": F.lag("sa").over(w)})
    split = F.coalesce(F.try_divide("p_cum", "cum"), F.lit(1.0))
    dividend = F.coalesce(F.col("p_sa") * (1 - F.try_divide("p_ratio", "ratio")) * F.col("p_cum"), F.lit(0.0))
    return s.select(*k, F.col("c").alias("Close"), F.round(split, digits).alias("SplitCoefficient"), F.round(dividend, digits).alias("DividendAmount"))


def listed_months(df: DataFrame, key: str, first: Column, last: Column) -> DataFrame:
    """Months from the first to the last day of each row, both counted, summed per key; rows the wrong way round count none."""
    months = F.months_between(F.trunc(last, "month"), F.trunc(first, "month")).cast("bigint") + 1
    return df.groupBy(key).agg(F.sum(F.greatest(F.coalesce(months, F.lit(0)), F.lit(0))).cast("bigint").alias("months"))


def split_adjust(df: DataFrame) -> DataFrame:
    """``sa_close``: Close over the product of all later splits of the symbol (the inverse of the above)."""
    later = Window.partitionBy("symbol").orderBy(F.col("Date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    factor = F.exp(F.coalesce(F.sum(F.ln("SplitCoefficient")).over(later), F.lit(0.0)))
    return df.withColumn("sa_close", F.col("Close") / factor)
