"""Coverage matrix of symbols by endpoint, its roll-ups, and the replay of what failed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.functions.expr import ratio
from quaymark.schemas import HARD_ISSUES


def init_matrix(symbols: DataFrame, columns: Sequence[str], today: Column) -> DataFrame:
    """All symbols with every cell unknown."""
    return symbols.select("symbol", "asset_type", *[F.lit(None).cast("boolean").alias(c) for c in columns], today.alias("date"))


def finalise_matrix(symbols: DataFrame, issues: DataFrame, ledger: DataFrame, applicable: Mapping[str, Sequence[str]], columns: Sequence[str], forgiving: Sequence[str] = ()) -> DataFrame:
    """One boolean per applicable cell, null where the endpoint does not apply.

    A cell is false after a hard issue (structure, throttling), or after empty content unless a
    ``forgiving`` endpoint has something in the ledger. Issues are flags pivoted over the
    known endpoints, so the matrix is two joins on the symbol whatever the number of columns.
    """
    hard = F.max(F.col("issue_type").isin(*HARD_ISSUES))
    empty = F.max(F.col("issue_type") == "empty_content")
    flags = issues.groupBy("symbol", "endpoint").agg(hard.alias("hard"), empty.alias("empty"))
    pick = lambda flag, c: F.max(F.when(F.col("endpoint") == c, F.col(flag)))
    wide = flags.groupBy("symbol").agg(*[pick(f, c).alias(f"{f}__{c}") for f in ("hard", "empty") for c in columns])
    saved = ledger.groupBy("symbol").agg(*[F.max(F.col("endpoint") == c).alias(f"saved__{c}") for c in columns])
    j = symbols.select("symbol", "asset_type").join(wide, "symbol", "left").join(saved, "symbol", "left")
    yes = lambda name: F.coalesce(F.col(name), F.lit(False))

    def cell(c: str) -> Column:
        kinds = [k for k, v in applicable.items() if c in v]
        bad = yes(f"hard__{c}") | (yes(f"empty__{c}") & ~(yes(f"saved__{c}") if c in forgiving else F.lit(False)))
        return F.when(F.col("asset_type").isin(*kinds), ~bad).alias(c)

    return j.select("symbol", "asset_type", *[cell(c) for c in columns])


def false_cells(matrix: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """(symbol, asset_type, endpoint) of every false cell; ``direct`` stands for the asset type itself."""
    long = matrix.unpivot(["symbol", "asset_type"], [c for c in columns if c not in skip], "endpoint", "ok").filter("ok = false")
    return long.select("symbol", "asset_type", F.when(F.col("endpoint") == "direct", F.col("asset_type")).otherwise(F.col("endpoint")).alias("endpoint"))


def rollup_matrix(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the true, false and unknown cells and the shares of the known ones: one pass."""
    named = [x for c in columns for x in (F.count_if(F.col(c)).alias(f"{c}__t"), F.count_if(~F.col(c)).alias(f"{c}__f"), F.count_if(F.col(c).isNull()).alias(f"{c}__n"))]
    row = matrix.agg(*named)
    parts = F.array(*[F.struct(F.lit(c).alias("endpoint"), F.col(f"{c}__t").alias("n_true"), F.col(f"{c}__f").alias("n_false"), F.col(f"{c}__n").alias("n_null")) for c in columns])
    known = F.col("n_true") + F.col("n_false")
    return row.select(F.inline(parts)).withColumns({"true_ratio": F.coalesce(ratio(F.col("n_true"), known, 4), F.lit(0.0)), "false_ratio": F.coalesce(ratio(F.col("n_false"), known, 4), F.lit(0.0))})


def retry_plan(issues: DataFrame, cells: DataFrame, day: Column, previous: Column, folder: Column, symbol_kinds: DataFrame) -> DataFrame:
    """Distinct (symbol, asset_type, endpoint) to fetch again: issues of the window and false cells of known symbols."""
    recent = issues.filter((day > previous) & (day <= folder) & (F.col("endpoint") != "sentiment")).select("symbol", "asset_type", "endpoint")
    typed = cells.select("symbol", "endpoint").join(symbol_kinds, "symbol").select("symbol", "asset_type", "endpoint")
    return recent.unionByName(typed).distinct()


def full_rerun(issues: DataFrame, day: Column, previous: Column, folder: Column) -> DataFrame:
    """One row ``full_rerun``: whether the window holds an issue of the news feed as a whole, which is then pulled again entirely."""
    hit = (day > previous) & (day <= folder) & (F.col("symbol") == "GLOBAL") & (F.col("endpoint") == "sentiment")
    return issues.agg(F.coalesce(F.max(hit), F.lit(False)).alias("full_rerun"))


def skipped_of(report: DataFrame, registry: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows of a report whose endpoint the registry does not have for their asset type: they are kept, not replayed."""
    known = F.lit(False)
    for kind, endpoints in registry.items():
        known = known | ((F.col("asset_type") == kind) & F.col("endpoint").isin(*endpoints))
    return report.filter(~F.coalesce(known, F.lit(False)))


def replace_endpoint(report: DataFrame, endpoint: str, fresh: DataFrame) -> DataFrame:
    """The report with all rows of one endpoint replaced."""
    return report.filter(~F.col("endpoint").eqNullSafe(F.lit(endpoint))).unionByName(fresh)


def merge_report(report: DataFrame, retried: DataFrame, fresh: DataFrame) -> DataFrame:
    """The report without the rows of retried triples, and the fresh rows."""
    return report.join(retried.select("symbol", "asset_type", "endpoint").distinct(), ["symbol", "asset_type", "endpoint"], "left_anti").unionByName(fresh)
