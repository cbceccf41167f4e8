"""The incremental pulls as Structured Streaming: windows with late data, dedupe, exactly-once merges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.operators.dedupe import SeenStore


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", str(files_per_trigger)) if files_per_trigger else reader).parquet(path)


def late_tolerant_counts(stream: DataFrame, at: str, by: list[str], width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Counts per window and key, kept open for data up to ``late`` behind."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *by).agg(F.count("*").alias("n"), F.max(at).alias("last"))


def once_within(stream: DataFrame, at: str, keys: list[str], late: str = "7 days") -> DataFrame:
    """Rows whose key was not seen within the watermark; the state is bounded by it."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def exactly_once(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]):
    """Runs ``apply(batch, number)`` on every batch that is there; it must be idempotent per number."""
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def deduplicate_forever(stream: DataFrame, store: SeenStore, ident, order, out: str, checkpoint: str):
    """Every message once, whenever its copies come: batches pass through the seen-bitmaps and land by batch number."""

    def step(batch: DataFrame, number: int) -> None:
        # a batch that is run again starts from the state before it and replaces its own directory
        store.apply(batch, ident, order, batch_id=number).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return exactly_once(stream, checkpoint, step)
