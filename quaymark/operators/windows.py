"""Incremental windows, overlap rules and point-in-time views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymark.functions.expr import next_page_bound, years_before


def half_open(day: Column, previous: Column, folder: Column) -> Column:
    """previous < day <= folder. Dates only; stamps must be cut to their day first."""
    return (day > previous) & (day <= folder)


def with_floor(previous: Column, folder: Column, days: int = 7) -> Column:
    """Lower bound that reaches back at least ``days``, to take in late data."""
    return F.least(previous, F.date_sub(folder, days))


def since(day: Column, folder: Column, years: int) -> Column:
    """day >= the same day ``years`` before ``folder``."""
    return day >= years_before(folder, years)


def latest_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``, which must settle all ties.

    Spark keeps only the group's first rows before the shuffle (WindowGroupLimit), so
    many repeats of a key don't travel.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def known_on(df: DataFrame, keys: Sequence[str], observed: str, day: Column, ties: Sequence[Column]) -> DataFrame:
    """State of every key as it was known on ``day``."""
    return latest_of(df.filter(F.col(observed) <= day), keys, [F.col(observed).desc(), *ties])


def restatements(df: DataFrame, keys: Sequence[str], observed: str, value: str, ties: Sequence[Column]) -> DataFrame:
    """Observations whose value differs from the one observed before, with both values."""
    w = Window.partitionBy(*keys).orderBy(F.col(observed), *ties)
    before = df.withColumn("old_value", F.lag(value).over(w)).withColumn("nth", F.row_number().over(w))
    return before.filter((F.col("nth") > 1) & ~F.col("old_value").eqNullSafe(F.col(value))).drop("nth")


def since_cutoff(df: DataFrame, day: str, cutoff: Column) -> DataFrame:
    """Folders from a cutoff on: what is to be brought over."""
    return df.filter(F.col(day) >= cutoff)


def previous_date(folders: DataFrame, day: str, state: DataFrame, folder: Column, floor_days: int = 7) -> DataFrame:
    """High-water mark of a run: one row ``previous``, the date of the state (all its rows have the same).

    Where no other folder than ``folder`` is there yet, the run is the first and reaches back ``floor_days``; a state without rows is null.
    """
    both = folders.select((F.col(day) != folder).alias("__other"), F.lit(None).cast("date").alias("__date")).unionByName(state.select(F.lit(None).cast("boolean").alias("__other"), F.col("date").alias("__date")))
    seen = both.agg(F.max("__other").alias("__other"), F.min("__date").alias("__date"))
    return seen.select(F.when(F.col("__other"), F.col("__date")).otherwise(F.date_sub(folder, floor_days)).alias("previous"))


def next_pages(rows: DataFrame, page: str, at: str, asked: str) -> DataFrame:
    """State of a walk back through pages: ``page``, its ``oldest`` row and the bound ``next_to`` to ask for next.

    The bound is the oldest time, a minute on; where that is no step back from what was ``asked``, it is forced a minute before.
    """
    bound = next_page_bound(F.col("oldest"))
    back = F.date_format(F.try_to_timestamp(F.col("asked"), F.lit("yyyyMMdd'T'HHmm")).cast("timestamp_ntz") - F.expr("INTERVAL 1 MINUTE"), "yyyyMMdd'T'HHmm")
    pages = rows.groupBy(page).agg(F.min(at).alias("oldest"), F.max(asked).alias("asked"))
    return pages.select(page, "oldest", F.when(bound >= F.col("asked"), back).otherwise(bound).alias("next_to"))


def latest_partition(days: DataFrame, day: str, cutoff: Column) -> DataFrame:
    """The latest day before ``cutoff``: one row, null if there is none."""
    return days.filter(F.col(day) < cutoff).agg(F.max(day).alias(day))
