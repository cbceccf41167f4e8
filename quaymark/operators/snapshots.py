"""Operators over periodic full snapshots of a table.

``latest_rows`` settles repeated and replaced rows, ``snapshot_changes`` tells
what changed between consecutive snapshots, ``build_chains`` and
``rebuild_affected`` keep the history of every entity.

Definitions shared by all of them. Rows without key or without snapshot date do
not count; where a key has several rows in one snapshot the one with the latest
load time stands, null load times being the earliest, and rows loaded at the same
time are settled by the largest row hash, so that the result does not depend on
the order of the input. Empty tables give empty results. Only the named columns are
read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.functions.text import canonical, canonical_symbol, fingerprint, spelled
from quaymark.session import cleaned, scratch_path, written
from quaymark.sources.sinks import Pointer

OPEN_END = "9999-12-31"


def _value(df: DataFrame, name: str) -> Column:
    """Texts in their canonical form, everything else as it is."""
    return canonical(F.col(f"`{name}`")) if dict(df.dtypes)[name] == "string" else F.col(f"`{name}`")


def _ranked(df: DataFrame, attributes: Sequence[str], loaded: str, keep_values: bool) -> Column:
    """Struct whose maximum is the standing row: load time, hash of the canonical attributes, and the trimmed values if kept."""
    kinds = dict(df.dtypes)
    parts = [F.col(f"`{loaded}`").alias("at"), fingerprint(*[_value(df, a) for a in attributes]).alias("h")]
    if keep_values:
        vals = [(spelled(F.col(f"`{a}`")) if kinds[a] == "string" else F.col(f"`{a}`")).alias(a) for a in attributes]
        parts.append(F.struct(*vals).alias("vals"))
    return F.struct(*parts)


def latest_rows(
    df: DataFrame, attributes: Sequence[str], key: str = "symbol", snapshot: str = "snapshot_date", loaded: str = "loaded_at", keep_values: bool = False
) -> DataFrame:
    """The standing row of every (snapshot, key): columns ``snap``, ``sym``, ``h``.

    ``h`` is a 128-bit hash over the canonical attributes. With ``keep_values`` the
    attributes come along as the struct ``vals``, texts trimmed. One aggregation
    with map-side combine, so repeated rows collapse before they are shuffled.
    """
    rows = df.select(F.col(f"`{snapshot}`").alias("snap"), canonical_symbol(F.col(f"`{key}`")).alias("sym"), _ranked(df, attributes, loaded, keep_values).alias("row"))
    best = rows.filter("snap IS NOT NULL AND sym IS NOT NULL").groupBy("snap", "sym").agg(F.max("row").alias("row"))
    return best.select("snap", "sym", "row.h", *(["row.vals"] if keep_values else []))


def calendar(rows: DataFrame, *by: str) -> DataFrame:
    """Each snapshot date with its neighbours: ``snap``, ``no``, ``prev_snap``, ``next_snap``.

    One row per date that occurs (and per ``by``): as snapshots are dated by day this
    is bounded by the days covered, some 37,000 rows in a century, whatever the size
    of the table. That bound is why it may be broadcast and numbered in one task.
    """
    w = Window.partitionBy(*by).orderBy("snap")
    return (
        rows.select(*by, "snap").distinct().withColumns({"no": F.row_number().over(w), "prev_snap": F.lag("snap").over(w), "next_snap": F.lead("snap").over(w)})
    )


def snapshot_changes(rows: DataFrame, *by: str) -> DataFrame:
    """Keys added, removed or changed against the snapshot before.

    ``rows`` comes from ``latest_rows``, with further columns ``by`` that tell tables
    apart. Every snapshot is full-outer-joined with the one before it on the key; a
    missing side is an addition or a removal, unequal hashes are a change. The first
    snapshot gives nothing. Both sides come from the same exchange, and the join key
    has the snapshot in it, so a key that occurs in every snapshot is no hot key.
    """
    days = F.broadcast(calendar(rows, *by))
    on = [*by, "snap"]
    later = rows.join(days.select(*on, "prev_snap"), on).filter("prev_snap IS NOT NULL").select(*on, "sym", F.col("h").alias("h_new"))
    earlier = rows.join(days.select(*on, "next_snap"), on).filter("next_snap IS NOT NULL").select(*by, F.col("next_snap").alias("snap"), "sym", F.col("h").alias("h_old"))
    change = (
        F.when(F.col("h_old").isNull(), "added").when(F.col("h_new").isNull(), "removed").when(F.col("h_old") != F.col("h_new"), "changed")
    )
    return later.join(earlier, [*on, "sym"], "full_outer").select(*on, "sym", change.alias("change")).filter("change IS NOT NULL")


def build_chains(rows: DataFrame, days: DataFrame) -> DataFrame:
    """All versions of every entity: ``sym``, ``vals``, ``h``, ``valid_from``, ``valid_to``.

    ``rows`` are standing rows with values, ``days`` the calendar of all snapshots. A
    version is an unbroken run of snapshots with equal hashes; it ends at the first
    later snapshot that does not list it so, or never (9999-12-31). An entity has at
    most one row per snapshot day here, so a window over it is bounded by the calendar.
    The values are those of the version's first snapshot.
    """
    w = Window.partitionBy("sym").orderBy("no")
    placed = rows.join(F.broadcast(days.select("snap", "no", "next_snap")), "snap")
    starts = F.lag("no").over(w).isNull() | (F.lag("no").over(w) != F.col("no") - 1) | (F.lag("h").over(w) != F.col("h"))
    runs = placed.withColumn("starts", F.when(starts, 1).otherwise(0)).withColumn("run", F.sum("starts").over(w))
    versions = runs.groupBy("sym", "run").agg(
        F.min(F.struct("no", "snap", "h", "vals")).alias("first"), F.max(F.struct("no", "next_snap")).alias("last")
    )
    return versions.select(
        "sym", "first.vals", "first.h", F.col("first.snap").alias("valid_from"), F.coalesce("last.next_snap", F.lit(OPEN_END).cast("date")).alias("valid_to")
    )


def rebuild_affected(chains: DataFrame, raw: DataFrame, touched: DataFrame, days: DataFrame) -> DataFrame:
    """``chains`` with those of the ``touched`` entities rebuilt from ``raw``.

    ``touched`` is a set of ``sym``; only their standing rows in ``raw`` are read into
    the rebuild, all other chains pass through untouched. Entities that ``raw`` no
    longer holds lose their chain.
    """
    touched = touched.select("sym").distinct()
    fresh = build_chains(raw.join(touched, "sym", "left_semi"), days)
    return chains.join(touched, "sym", "left_anti").unionByName(fresh)


def found_changes(listings: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``snapshot_changes`` over several listings: ``asset_type``, ``snapshot_date``, ``symbol``, ``change``."""
    parts = [latest_rows(df, attributes).withColumn("asset_type", F.lit(kind)) for kind, (df, attributes) in listings.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return snapshot_changes(rows, "asset_type").select("asset_type", F.date_format("snap", "yyyy-MM-dd").alias("snapshot_date"), F.col("sym").alias("symbol"), "change")


def history(df: DataFrame, attributes: Sequence[str], snapshot: str = "snapshot_date", loaded: str = "loaded_at") -> DataFrame:
    """Full history of a listing by affected-chain rebuild.

    What arrived while its snapshot was the current one is the first delivery to a ``HistoryStore``, what
    arrived once a later snapshot was there the second one: late updates, for which only
    the entities they touch are rebuilt and their chains replaced. Columns: ``symbol``, the
    attributes, ``valid_from``, ``valid_to`` (dates).
    """
    spark = df.sparkSession
    keyed = df.select(F.col(f"`{snapshot}`").alias("snapshot_date"), "symbol", F.col(f"`{loaded}`").alias("loaded_at"), *[f"`{a}`" for a in attributes])
    days = calendar(df.select(F.col(f"`{snapshot}`").alias("snap"), canonical_symbol(F.col("symbol")).alias("sym")).filter("snap IS NOT NULL AND sym IS NOT NULL"))
    days = written(days, "calendar")
    late = F.coalesce(F.to_date("loaded_at") >= F.col("next_snap"), F.lit(False))
    marked = keyed.join(F.broadcast(days.select(F.col("snap").alias("snapshot_date"), "next_snap")), "snapshot_date").withColumn("__late", late).drop("next_snap")
    store = HistoryStore(spark, scratch_path(spark, "history"), attributes)
    store.deliver(marked.filter("NOT __late"), 1)
    store.deliver(marked.filter("__late"), 2)
    return store.read()


class HistoryStore:
    """History of a listing, kept on deliveries of any snapshot in any order.

    Standing rows are kept by delivery number, chains in ``buckets`` by a hash of the entity, versions that have
    ended apart from those still open. A small pointer file names the folders in force and is renamed into place,
    so a delivery takes effect at once or not at all, and readers keep what they opened.

    * An ordinary delivery, all of it later than any snapshot known, rebuilds nothing: per snapshot one join with the open
      versions tells which end and which begin; what ended is added, only the open ones are written again.
    * Any other delivery is late: the entities it touches (those it lists, those it listed when it was given
      before under its number, and those with a version around a snapshot date that was not known) are looked up in
      their buckets, all their intervals are rebuilt from their rows in all deliveries, and the buckets
      they lie in are replaced; other buckets are neither read nor written.
    """

    def __init__(self, spark: SparkSession, path: str, attributes: Sequence[str], buckets: int = 16, merge_after: int = 16):
        self.spark, self.path, self.attributes, self.buckets, self.merge_after = spark, path.rstrip("/"), list(attributes), buckets, merge_after
        self._pointer = Pointer(spark, self.path)

    def current(self) -> dict:
        """Folders in force: ``raw`` by delivery number, ``ended`` (lists) and ``open`` by bucket; ``schema`` of rows and chains."""
        return json.loads(self._pointer.get() or '{"raw": {}, "ended": {}, "open": {}}')

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("sym"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _write(self, df: DataFrame) -> str:
        folder = uuid.uuid4().hex
        with cleaned(self.spark):
            df.select("*", self._bucket()).repartition(self.buckets, "bucket").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.path}/{folder}")
        return folder

    def _write_chains(self, chains: DataFrame) -> tuple[str, str]:
        """Folders of the ended and of the open versions, from one write."""
        folder, still = uuid.uuid4().hex, (F.col("valid_to") == F.lit(OPEN_END).cast("date")).cast("int").alias("still_open")
        with cleaned(self.spark):
            chains.select("*", still, self._bucket()).repartition(self.buckets, "bucket").write.partitionBy("still_open", "bucket").option("compression", "zstd").parquet(f"{self.path}/{folder}")
        return f"{folder}/still_open=0", f"{folder}/still_open=1"

    def _read(self, folders: Sequence[str], schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of folders, of certain buckets only if given; folders that have no file of a bucket are passed over."""
        paths = [f"{f}/bucket={b}" for f in folders for b in (range(self.buckets) if buckets is None else buckets)]
        there = [f"{self.path}/{p}" for p in paths if self._pointer.exists(p)]
        return self.spark.read.schema(schema).parquet(*there) if there else self.spark.createDataFrame([], schema)

    def _chains(self, state: dict, which: str, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(state["chains"])
        paths = [f"{f}/bucket={b}" for b, fs in state[which].items() if buckets is None or int(b) in buckets for f in ([fs] if isinstance(fs, str) else fs)]
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], schema)

    def _standing(self, raw: DataFrame) -> DataFrame:
        best = raw.groupBy("snap", "sym").agg(F.max("row").alias("row"))
        return best.select("snap", "sym", "row.h", "row.vals")

    def _named(self, folder: str, buckets: Sequence[int]) -> list[int]:
        return [b for b in buckets if self._pointer.exists(f"{folder}/bucket={b}")]

    def _put(self, state: dict, chains: DataFrame, buckets: Sequence[int]) -> None:
        """Replace all chains of some buckets."""
        folder_ended, folder_open = self._write_chains(chains)
        for b in buckets:
            state["ended"].pop(str(b), None)
            state["open"].pop(str(b), None)
        state["ended"] |= {str(b): [folder_ended] for b in self._named(folder_ended, buckets)}
        state["open"] |= {str(b): folder_open for b in self._named(folder_open, buckets)}

    def deliver(self, df: DataFrame, number: int) -> int:
        """Take in rows with ``symbol``, ``snapshot_date``, ``loaded_at`` and the attributes; gives the number of entities rebuilt."""
        state = self.current()
        rows = df.select(F.col("snapshot_date").alias("snap"), canonical_symbol(F.col("symbol")).alias("sym"), _ranked(df, self.attributes, "loaded_at", True).alias("row"))
        rows = rows.filter("snap IS NOT NULL AND sym IS NOT NULL").groupBy("snap", "sym").agg(F.max("row").alias("row"))
        schema = rows.schema
        folder, before = self._write(rows), state["raw"].get(str(number))
        fresh = self._read([folder], schema)
        others = [f for n, f in state["raw"].items() if n != str(number)]
        state["raw"][str(number)] = folder
        # dates only, bounded by the calendar
        dates = lambda part: sorted(r.snap for r in part.select("snap").distinct().collect())
        known, came, everything = dates(self._read(others, schema)) if others else [], dates(fresh), self._read(list(state["raw"].values()), schema)
        every, rebuilt = list(range(self.buckets)), 0
        if not others:
            chains = build_chains(self._standing(fresh), calendar(fresh))
            state["chains"] = json.loads(chains.schema.json())
            self._put(state, chains, every)
        elif came and not before and known and came[0] > known[-1]:
            for day in came:
                self._append(state, self._standing(fresh.filter(F.col("snap") == F.lit(day))), day)
        else:
            touched = fresh.select("sym") if before is None else fresh.select("sym").unionByName(self._read([before], schema).select("sym"))
            moved = sorted(set(came) ^ set(known)) if before else sorted(set(came) - set(known))
            if moved:
                around = F.exists(F.array(*map(F.lit, moved)), lambda d: (d > F.col("valid_from")) & (d <= F.col("valid_to")))
                touched = touched.unionByName(self._chains(state, "ended").unionByName(self._chains(state, "open")).filter(around).select("sym"))
            touched = written(touched.distinct(), "touched")
            per_bucket = touched.groupBy(self._bucket()).count().collect()  # a row per bucket
            hit, rebuilt = sorted(r.bucket for r in per_bucket), sum(r["count"] for r in per_bucket)
            if hit:
                old = self._chains(state, "ended", hit).unionByName(self._chains(state, "open", hit))
                raw = self._read(list(state["raw"].values()), schema, hit).join(touched, "sym", "left_semi")
                self._put(state, rebuild_affected(old, self._standing(raw), touched, calendar(everything)), hit)
        self._pointer.set(json.dumps(state))
        return rebuilt

    def _append(self, state: dict, rows: DataFrame, day: dt.date) -> None:
        """A snapshot later than all before: versions that go on stay as they are, others end, new ones begin."""
        at, never = F.lit(day), F.lit(OPEN_END).cast("date")
        j = self._chains(state, "open").withColumn("__on", F.lit(True)).join(rows.select("sym", F.col("h").alias("__h"), F.col("vals").alias("__vals")), "sym", "full_outer")
        j = written(j, "appended")
        goes_on = F.coalesce(F.col("h") == F.col("__h"), F.lit(False))
        stays = j.filter(goes_on).select("sym", "vals", "h", "valid_from", "valid_to")
        begins = j.filter(F.col("__h").isNotNull() & ~goes_on).select("sym", F.col("__vals").alias("vals"), F.col("__h").alias("h"), at.alias("valid_from"), never.alias("valid_to"))
        ends = j.filter(F.col("__on") & ~goes_on).select("sym", "vals", "h", "valid_from", at.alias("valid_to"))
        every = list(range(self.buckets))
        if any(len(x) >= self.merge_after for x in state["ended"].values()):
            ends, state["ended"] = ends.unionByName(self._chains(state, "ended")), {}
        folder_ended, folder_open = self._write_chains(ends.unionByName(stays).unionByName(begins))
        for b in self._named(folder_ended, every):
            state["ended"].setdefault(str(b), []).append(folder_ended)
        state["open"] = {str(b): folder_open for b in self._named(folder_open, every)}

    def read(self) -> DataFrame:
        """``symbol``, the attributes, ``valid_from``, ``valid_to``."""
        state = self.current()
        chains = self._chains(state, "ended").unionByName(self._chains(state, "open"))
        return chains.select(F.col("sym").alias("symbol"), *[F.col(f"vals.`{a}`").alias(a) for a in self.attributes], "valid_from", "valid_to")
