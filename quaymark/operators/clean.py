"""Cleaning with an issue side-channel: what a cast or a check loses is named, never silently dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.functions import expr


def cast_columns(df: DataFrame, key: str, numbers: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(clean, issues): text columns as doubles, and one ``cast_failure`` per key and column that lost a value.

    Sentinels are null and no failure. Failures are counted in one aggregation over the
    wide frame and unpivoted after it, so the rows are not multiplied by the columns.
    """
    values = {c: expr.number(expr.without_sentinels(c)) for c in numbers}
    clean = df.select(key, *[c for c in df.columns if c != key and c not in numbers], *[v.alias(c) for c, v in values.items()])
    lost = df.groupBy(key).agg(*[F.count_if(expr.cast_issue(expr.without_sentinels(c), v)).alias(c) for c, v in values.items()])
    issues = lost.unpivot([key], list(numbers), "column", "n").filter("n > 0").select(key, F.lit("cast_failure").alias("issue_type"), F.col("column").alias("detail"), "n")
    return clean, issues


def null_issues(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """One issue per key whose rows have nulls in ``values``, with how many."""
    nulls = sum((F.when(F.col(v).isNull(), 1).otherwise(0) for v in values), F.lit(0))
    return df.groupBy(key).agg(F.sum(nulls).alias("n")).filter("n > 0").select(key, F.lit("cast_failure").alias("issue_type"), F.concat(F.col("n").cast("string"), F.lit(" null values")).alias("detail"))


def time_zone_issue(meta: Column, expected: str) -> Column:
    """``structure_error`` without meta data, ``timezone_mismatch`` for another zone than expected, else null."""
    named = F.get(F.filter(F.map_keys(meta), lambda k: k.rlike(r"^\d+\.\s*Time Zone$")), F.lit(0))
    zone = F.element_at(meta, named)
    return F.when(meta.isNull(), "structure_error").when(zone.isNotNull() & (zone != expected), "timezone_mismatch")


def missing_keys(record: Column, required: Sequence[str]) -> Column:
    """Required keys that a map lacks, joined by ``;``; null when it has them all."""
    lacking = F.array_except(F.array(*map(F.lit, required)), F.coalesce(F.map_keys(record), F.array()))
    return F.nullif(F.array_join(lacking, ";"), F.lit(""))


def applicable(registry: Mapping[str, Sequence[str]], disabled: frozenset[str]) -> dict[str, tuple[str, ...]]:
    """The registry without disabled asset types."""
    return {k: tuple(v) for k, v in registry.items() if k not in disabled}


def known_empty(cells: DataFrame, endpoint: str) -> DataFrame:
    """Symbols whose cell is false: to be skipped, with a synthetic ``empty_content`` issue each. Unknown cells are not skipped."""
    return cells.filter(F.col(endpoint) == F.lit(False)).select("symbol", F.lit(endpoint).alias("endpoint"), F.lit("empty_content").alias("issue_type"))
