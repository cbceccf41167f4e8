"""Asset catalogs: collapse of listings, merge of sources and of daily listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collapse_listing(df: DataFrame, key: str, order: Sequence[Column], ipo: str) -> DataFrame:
    """One row per key, the first in ``order``, with the earliest ``ipo`` of all its rows: one window pass."""
    w = Window.partitionBy(key)
    return (
        df.withColumns({"__ipo": F.min(ipo).over(w), "__rn": F.row_number().over(w.orderBy(*order))})
        .filter("__rn = 1")
        .withColumn(ipo, F.col("__ipo"))
        .drop("__ipo", "__rn")
    )


def preferred_source(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All rows of ``first`` and those of ``second`` whose key it lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def disagreements(first: DataFrame, second: DataFrame, key: str, field: str) -> DataFrame:
    """Keys on both sides whose field differs; null on either side is no disagreement."""
    a, b = first.select(key, F.col(field).alias("first_value")), second.select(key, F.col(field).alias("second_value"))
    return a.join(b, key).filter("first_value <> second_value")


def merge_listing(old: DataFrame, fresh: DataFrame, other_active: DataFrame, today: Column, key: str = "symbol", grace_days: int = 30) -> DataFrame:
    """Next state of a catalog from its last state and today's listing, in one full outer join.

    Both sides have ``key``, ``ipo``, ``delisting``, ``status``; ``other_active`` the keys active under another
    asset type. Added keys come in as listed. A key that vanished gets today as delisting
    date and is Corrupted, or Delisted when active elsewhere; a Corrupted one without a
    date younger than the grace period becomes Delisted; Delisted stays. For keys on both sides the earlier ipo wins, the delisting
    date is the listing's, and a listed Active revives, a listed Delisted ends what is not
    yet ended; an unknown status stays unknown.
    """
    o = old.select(key, F.col("ipo").alias("o_ipo"), F.col("delisting").alias("o_del"), F.col("status").alias("o_st"), F.lit(True).alias("o_in"))
    f = fresh.select(key, F.col("ipo").alias("f_ipo"), F.col("delisting").alias("f_del"), F.col("status").alias("f_st"), F.lit(True).alias("f_in"))
    x = other_active.select(key).distinct().withColumn("elsewhere", F.lit(True))
    j = o.join(f, key, "full_outer").join(x, key, "left")
    added, gone = F.col("o_in").isNull(), F.col("f_in").isNull()
    elsewhere = F.coalesce("elsewhere", F.lit(False))
    ended = F.col("o_st").isin("Corrupted", "Delisted")
    status = (
        F.when(added, F.col("f_st"))
        .when(gone & F.col("o_del").isNull(), F.when(elsewhere, "Delisted").otherwise("Corrupted"))
        .when(gone & (F.col("o_st") == "Corrupted") & ((F.col("o_del") < F.date_sub(today, grace_days)) | elsewhere), "Delisted")
        .when(gone, F.col("o_st"))
        .when(ended & (F.col("f_st") == "Active"), "Active")
        .when(~ended & (F.col("f_st") == "Delisted"), "Delisted")
        .otherwise(F.col("o_st"))
    )
    delisting = F.when(added, F.col("f_del")).when(gone, F.coalesce("o_del", today)).otherwise(F.col("f_del"))
    return j.select(key, F.least("o_ipo", "f_ipo").alias("ipo"), delisting.alias("delisting"), status.alias("status"))


def active_collisions(first: DataFrame, second: DataFrame, key: str = "symbol", status: str = "status") -> DataFrame:
    """Keys that both listings hold as Active."""
    active = lambda df: df.filter(F.lower(F.trim(status)) == "active").select(key)
    return active(first).intersect(active(second))


def with_sector(catalog: DataFrame, lookup: DataFrame, other: str | None = None, key: str = "symbol") -> DataFrame:
    """``catalog`` with missing sectors filled from ``lookup``, then from ``other``. A key looked up twice takes its first sector by name."""
    found = lookup.groupBy(key).agg(F.min("sector").alias("__sector"))
    filled = F.coalesce("sector", "__sector", *([F.lit(other)] if other else []))
    return catalog.join(found, key, "left").withColumn("sector", filled).drop("__sector")


def initial_catalog(first: DataFrame, second: DataFrame | None, lookup: DataFrame, key: str = "symbol") -> DataFrame:
    """First state of a catalog with sectors: the preferred source, what only the other lists, and sectors looked up where neither has one."""
    both = first if second is None else preferred_source(first, second, key)
    return with_sector(both, lookup, key=key)


def carried(old: DataFrame, fresh: DataFrame, columns: Sequence[str], key: str = "symbol") -> DataFrame:
    """Descriptive columns of every key on either side: as the last state has them, as listed for added keys."""
    o = old.select(key, F.struct(*columns).alias("__o"))
    f = fresh.select(key, F.struct(*columns).alias("__f"))
    kept = F.coalesce("__o", "__f")
    return o.join(f, key, "full_outer").select(key, *[kept.getField(c).alias(c) for c in columns])


def update_catalog(old: DataFrame, fresh: DataFrame, other_active: DataFrame, today: Column, lookup: DataFrame | None = None, columns: Sequence[str] = ("name",), key: str = "symbol") -> DataFrame:
    """Next state of a catalog with its descriptive columns: ``merge_listing`` beside what is ``carried``.

    With ``lookup`` added keys get their sector from it, ``Other`` where it has none.
    """
    merged = merge_listing(old, fresh, other_active, today, key)
    texts = carried(old, fresh, columns, key)
    if lookup is not None:
        added = with_sector(texts.join(old.select(key), key, "left_anti"), lookup, "Other", key)
        texts = texts.join(old.select(key), key, "left_semi").unionByName(added)
    return texts.join(merged, key)


def trimmed(catalog: DataFrame, dependent: DataFrame, mandatory: DataFrame, k: int, seed: str, key: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """The mandatory keys and ``k`` others by the rank of a hash, and the rows of a dependent table that belong to them."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    drawn = catalog.join(mandatory.select(key), key, "left_anti").select(key, rank.alias("__h")).orderBy("__h", key).limit(k).select(key)
    kept = catalog.join(mandatory.select(key).unionByName(drawn).distinct(), key, "left_semi")
    return kept, dependent.join(kept.select(key), key, "left_semi")


def strided(df: DataFrame, order: str, step: int, k: int) -> DataFrame:
    """Every ``step``-th row in order, the first ``k`` of them; only the first ``step * k`` rows travel."""
    few = df.orderBy(order).limit(step * k)
    nth = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(order))
    return few.withColumn("__n", nth).filter((F.col("__n") - 1) % step == 0).drop("__n")


def merge_simple(old: DataFrame, fresh: DataFrame, today: Column, key: str = "symbol", grace_days: int = 30) -> DataFrame:
    """As ``merge_listing`` for lists of symbols only: any status ends after the grace period, and a return clears the date."""
    o = old.select(key, F.col("delisting").alias("o_del"), F.col("status").alias("o_st"), F.lit(True).alias("o_in"))
    j = o.join(fresh.select(key, F.lit(True).alias("f_in")), key, "full_outer")
    gone, back = F.col("f_in").isNull(), F.col("o_st").isin("Corrupted", "Delisted")
    status = (
        F.when(gone & F.col("o_del").isNull(), "Corrupted").when(gone & (F.col("o_del") < F.date_sub(today, grace_days)), "Delisted").when(gone, F.col("o_st")).when(back, "Active").otherwise(F.col("o_st"))
    )
    delisting = F.when(gone, F.coalesce("o_del", today)).when(~back | F.col("o_st").isNull(), F.col("o_del"))
    return j.select(key, delisting.alias("delisting"), status.alias("status"))


def first_catalog(catalogs: Sequence[tuple[str, DataFrame]], key: str = "symbol") -> DataFrame:
    """Asset type of each key, the first catalog winning where several have it."""
    parts = [df.select(key, F.lit(kind).alias("asset_type"), F.lit(i).alias("priority")) for i, (kind, df) in enumerate(catalogs)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy(key).agg(F.min_by("asset_type", "priority").alias("asset_type"))
