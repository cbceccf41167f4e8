"""Exactly one copy of every message that was delivered at least once.

Identifiers are dictionary-encoded exactly: each distinct identifier gets a number of
its own within its shard, and a compressed bitmap per shard and range of numbers says
which have been seen. One arrival is selected for every unseen bit, then the new bits
are united with the old ones and published at once.

The identifier is a set of columns compared by value; null is a value like any other
in it. The copy that stays is the one with the smallest arrival number. Rows whose
``required`` columns are null have no identifier and are always kept. Rows that
repeat an arrival number within one identifier count as the same delivery. Empty
batches leave the state as it is.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaymark.session import written

DICTIONARY = "ident binary, shard int, code long"
BITS = "shard int, bucket long, bits binary"


def identifier(*cols: Column) -> Column:
    """The identifier as one binary: its columns as text, each with its length, so no two tuples are alike."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in cols]
    return F.encode(F.concat_ws(",", *parts), "UTF-8")


def _shard(ident: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(ident), F.lit(shards)).cast("int")


def arrivals(batch: DataFrame, ident: Column, order: Column, shards: int) -> DataFrame:
    """First arrival per identifier: ``shard``, ``ident``, ``first``. Copies collapse before the shuffle."""
    return (
        batch.select(ident.alias("ident"), order.cast("bigint").alias("first"))
        .filter("ident IS NOT NULL")
        .groupBy(_shard(F.col("ident"), shards).alias("shard"), "ident")
        .agg(F.min("first").alias("first"))
    )


def encode(first: DataFrame, dictionary: DataFrame | None = None, slim: bool = False) -> DataFrame:
    """``first`` with the exact ``code`` of every identifier and a hash ``h`` of it.

    Identifiers in the dictionary keep their code, new ones follow on in their shard.
    With ``slim`` the identifiers themselves are left behind before codes are given,
    so that only small rows move again; a group is named by its first arrival then.
    """
    h = F.xxhash64("ident").alias("h")
    rest = [] if slim else ["ident"]
    if dictionary is None:
        rows = first.select("shard", "first", h, *rest, F.lit(None).cast("bigint").alias("old"), F.lit(0).cast("bigint").alias("base"))
    else:
        # one row per shard
        base = dictionary.groupBy("shard").agg((F.max("code") + 1).alias("base"))
        rows = first.join(dictionary.select("shard", "ident", F.col("code").alias("old")), ["shard", "ident"], "left").select("shard", "first", h, *rest, "old")
        rows = rows.join(F.broadcast(base), "shard", "left").withColumn("base", F.coalesce("base", F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("shard", F.col("old").isNull()).orderBy("h", "first"))
    return rows.withColumn("code", F.coalesce("old", F.col("base") + nth - 1)).drop("old", "base")


def unseen(coded: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The coded arrivals whose bit is not set in ``seen``."""
    # bitmap_bucket_number counts from 1 for numbers from 1
    placed = coded.withColumns({"bucket": F.bitmap_bucket_number(F.col("code") + 1), "bit": F.bitmap_bit_position(F.col("code") + 1)})
    if seen is None:
        return placed
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False))
    return placed.join(seen, ["shard", "bucket"], "left").filter(~is_set).drop("bits")


def united(new: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The seen bits with those of ``new``: one bitmap per shard and bucket of 32,768 codes."""
    fresh = new.groupBy("shard", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    if seen is None:
        return fresh
    return seen.unionByName(fresh).groupBy("shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def duplicates(table: DataFrame, ident: Column, order: Column, shards: int = 64, waves: int = 2) -> DataFrame:
    """Arrival numbers of the rows of a whole table that must go: column ``arrival``.

    The table is replayed as ``waves`` consecutive ranges of arrival numbers. Each wave is encoded over
    the dictionary so far, passes one arrival per bit that is not seen yet, and its
    dictionary and bits are written for the next; what passed in no wave must go. Rows are
    told from the arrivals that passed by number and a hash of the identifier, so that rows
    never travel with their identifiers. Shards should grow with the table: the codes of a
    shard are given in one task.
    """
    rows = table.select(order.cast("bigint").alias("arrival"), ident.alias("ident")).filter("ident IS NOT NULL")
    # over all rows, so that this scan reads one column
    low, high = table.agg(F.min(order.cast("bigint")), F.max(order.cast("bigint"))).first()
    passed, dictionary, seen = None, None, None
    for k in range(waves if low is not None else 1):
        part = rows
        if low is not None:
            a, b = (low + (high + 1 - low) * i // waves for i in (k, k + 1))
            part = rows.filter((F.col("arrival") >= a) & (F.col("arrival") < b))
        last = low is None or k == waves - 1
        coded = unseen(encode(arrivals(part, F.col("ident"), F.col("arrival"), shards), dictionary, slim=last), seen)
        if not last:
            coded = written(coded, "wave")
            words = coded.select("ident", "shard", "code")
            dictionary = words if dictionary is None else dictionary.unionByName(words)
            seen = written(united(coded, seen), "seen-bits")
        kept = coded.select(F.col("first").alias("arrival"), "h")
        passed = kept if passed is None else passed.unionByName(kept)
    return rows.select("arrival", F.xxhash64("ident").alias("h")).join(passed, ["arrival", "h"], "left_anti").select("arrival")


class SeenStore:
    """Dictionary and seen-bitmaps of all batches so far, in a folder all executors share.

    A batch adds its new words and bits beside what is there, then a small pointer file that
    names all parts is renamed into place: what a batch writes grows with the batch, not with the store. A run that
    breaks off leaves the current state in force, and its batch may be given again.
    After ``merge_after`` batches the bits are united into one part.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int = 64, merge_after: int = 16):
        self.spark, self.path, self.shards, self.merge_after = spark, path.rstrip("/"), shards, merge_after
        jvm = spark._jvm
        self._paths = jvm.org.apache.hadoop.fs.Path
        self._fs = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def current(self) -> dict:
        """What is in force: ``words`` and ``bits`` (folders), the ``batch`` that made it, ``before`` it; empty at first."""
        at = self._paths(f"{self.path}/CURRENT")
        if not self._fs.exists(at):
            return {}
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def state(self, entry: dict | None = None) -> tuple[DataFrame | None, DataFrame | None]:
        """Dictionary and bits, by default those in force."""
        entry = self.current() if entry is None else entry
        if not entry:
            return None, None
        read = lambda schema, parts: self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in parts])
        bits = read(BITS, entry["bits"])
        if len(entry["bits"]) > 1:
            bits = bits.groupBy("shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return read(DICTIONARY, entry["words"]), bits

    def _publish(self, entry: dict) -> None:
        fresh = self._paths(f"{self.path}/CURRENT.{uuid.uuid4().hex}")
        out = self._fs.create(fresh, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration()).rename(fresh, self._paths(f"{self.path}/CURRENT"), options)

    def apply(self, batch: DataFrame, ident: Column, order: Column, batch_id: int | None = None) -> DataFrame:
        """The rows of ``batch`` to pass on; their identifiers count as seen from now on.

        A batch that is given again right away under the same ``batch_id`` (a stream
        that broke off between this step and its own) starts from the state before it and
        passes the same rows again.
        """
        now = self.current()
        again = bool(now) and batch_id is not None and now["batch"] == batch_id
        base = now["before"] if again else now
        dictionary, seen = self.state(base)
        chosen = written(unseen(encode(arrivals(batch, ident, order, self.shards), dictionary), seen), "arrivals")
        v = uuid.uuid4().hex
        chosen.select("ident", "shard", "code").write.option("compression", "zstd").parquet(f"{self.path}/{v}/words")
        parts = base.get("bits", [])
        merge = len(parts) >= self.merge_after
        united(chosen, seen if merge else None).write.option("compression", "zstd").parquet(f"{self.path}/{v}/bits")
        entry = {"words": [*base.get("words", []), f"{v}/words"], "bits": [f"{v}/bits"] if merge else [*parts, f"{v}/bits"], "batch": batch_id}
        self._publish(entry | {"before": {k: x for k, x in base.items() if k != "before"}})
        keep = chosen.select(F.col("first").alias("__arrival"), F.col("ident").alias("__ident"))
        rows = batch.withColumns({"__arrival": order.cast("bigint"), "__ident": ident})
        with_id = rows.filter("__ident IS NOT NULL").join(keep, ["__arrival", "__ident"], "left_semi")
        once = with_id.dropDuplicates(["__arrival", "__ident"])
        return once.unionByName(rows.filter("__ident IS NULL")).drop("__arrival", "__ident")
