"""Writing tables: versioned replacement, appended issues, the coverage ledger, and report text."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Pointer:
    """A small text file that says what is in force, replaced by a rename, so that readers see the old or the new one and never a part."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def get(self) -> str | None:
        at = self._at("CURRENT")
        fs = at.getFileSystem(self._conf)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def set(self, text: str) -> None:
        fresh = self._at(f"CURRENT.{uuid.uuid4().hex}")
        out = fresh.getFileSystem(self._conf).create(fresh, True)
        out.write(bytearray(text.encode()))
        out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self._conf).rename(fresh, self._at("CURRENT"), options)

    def exists(self, name: str) -> bool:
        at = self._at(name)
        return at.getFileSystem(self._conf).exists(at)


class VersionedTable:
    """A table that is replaced as a whole: a version is written beside the last one, then a pointer file is renamed.

    A new state may be computed from the current one, as readers keep the version they
    opened, and a run that breaks off changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._pointer = spark, path.rstrip("/"), Pointer(spark, path)

    def version(self) -> str | None:
        return self._pointer.get()

    def read(self) -> DataFrame | None:
        v = self.version()
        return None if v is None else self.spark.read.parquet(f"{self.path}/{v}")

    def replace(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        v = uuid.uuid4().hex
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(f"{self.path}/{v}")
        self._pointer.set(v)


def append_issues(issues: DataFrame, path: str) -> None:
    """Add issues to the report; nothing is written when there are none."""
    if not issues.isEmpty():
        issues.write.mode("append").option("compression", "zstd").parquet(path)


def ledger(df: DataFrame, endpoint: str, attempted: DataFrame) -> DataFrame:
    """One row per attempted symbol with the rows it got, so that none is told from never asked."""
    return attempted.select("symbol").distinct().join(df.groupBy("symbol").agg(F.count("*").alias("n_rows")), "symbol", "left").select("symbol", F.lit(endpoint).alias("endpoint"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def not_yet_done(symbols: DataFrame, done: DataFrame) -> DataFrame:
    """Symbols without a ledger row: what a resumed run still has to fetch."""
    return symbols.join(done.select("symbol"), "symbol", "left_anti")


def write_by_day(df: DataFrame, path: str, day: str = "folder_date") -> None:
    """Write by day partition, replacing only the days in ``df``; files are sized by hash within the day."""
    df.repartition(day, F.pmod(F.xxhash64("symbol"), F.lit(16))).sortWithinPartitions("symbol").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(day).parquet(path)


def write_by_symbol(df: DataFrame, path: str, attempted: DataFrame, endpoint: str) -> DataFrame:
    """Write the symbols that have no output yet, sorted by date within a symbol, and give the ledger of this run.

    Symbols are partitions, those already there are left as they are. Symbols without rows are in the ledger, so that none is told from never asked.
    """
    spark = df.sparkSession
    there = Pointer(spark, path).exists("_SUCCESS")
    todo = attempted.select("symbol").distinct()
    if there:
        todo = not_yet_done(todo, spark.read.parquet(path).select("symbol").distinct())
    rows = df.join(todo, "symbol", "left_semi")
    date = next((c for c in ("Date", "time_published", "fiscalDateEnding") if c in df.columns), "symbol")
    rows.repartition("symbol").sortWithinPartitions("symbol", date).write.mode("append").option("compression", "zstd").partitionBy("symbol").parquet(path)
    return ledger(rows, endpoint, todo)


def news_by_symbol(news: DataFrame, active: DataFrame) -> DataFrame:
    """News of active symbols only, under their symbol."""
    return news.withColumn("symbol", F.col("ticker")).join(active.select("symbol").distinct(), "symbol", "left_semi")


def retire(spark: SparkSession, path: str, suffix: str = ".pre_weekly") -> bool:
    """Move a table aside before it is written anew, over an older one moved aside; whether there was one."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    at, old = fs_path(path.rstrip("/")), fs_path(path.rstrip("/") + suffix)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return False
    fs.delete(old, True)
    return fs.rename(at, old)


#: Key of a report's JSON that names the sections cut for display.
CUT_SECTIONS = "cut_sections"


def report_text(sections: dict[str, DataFrame], most_rows: int = 50) -> tuple[str, str]:
    """(JSON, Markdown) of small report tables; long tables are cut for display, and say so.

    In the JSON ``CUT_SECTIONS`` then lists the sections that have more rows than shown.
    """
    if CUT_SECTIONS in sections:
        raise ValueError(f"no section may be named {CUT_SECTIONS}")
    data, lines, cut = {}, [], []
    for name, df in sections.items():
        rows = df.limit(most_rows + 1).collect()
        cut += [name] if len(rows) > most_rows else []
        data[name] = [json.loads(json.dumps(r.asDict(recursive=True), default=str)) for r in rows[:most_rows]]
        lines += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows[:most_rows]] + (["", f"(more than {most_rows} rows)"] if len(rows) > most_rows else []) + [""]
    return json.dumps(data | ({CUT_SECTIONS: cut} if cut else {})), "\n".join(lines)
