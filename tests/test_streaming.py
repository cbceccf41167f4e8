import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.operators import dedupe
from quaymark.streaming import incremental

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("at", T.TimestampType())])


def rows(*ids):
    return [(i, u, dt.datetime(2024, 1, 1, 1 + i % 20)) for i, u in ids]


def test_messages_pass_once_over_batches(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame(rows((1, "a"), (2, "a"), (3, "b")), SCHEMA).coalesce(1).write.mode("append").parquet(src)
    store = dedupe.SeenStore(spark, f"file://{tmp_path}/seen", shards=2)

    def run():
        stream = incremental.read_stream(spark, src, SCHEMA)
        incremental.deduplicate_forever(stream, store, dedupe.identifier(F.col("url")), F.col("id"), f"{tmp_path}/out", f"{tmp_path}/ck")
        return sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == [1, 3]
    spark.createDataFrame(rows((4, "b"), (5, "c")), SCHEMA).coalesce(1).write.mode("append").parquet(src)
    assert run() == [1, 3, 5]


def test_a_batch_given_again_passes_the_same_rows(spark, tmp_path):
    store = dedupe.SeenStore(spark, f"file://{tmp_path}/seen", shards=2)
    apply = lambda ids, n: sorted(r.id for r in store.apply(spark.createDataFrame(rows(*ids), SCHEMA), dedupe.identifier(F.col("url")), F.col("id"), batch_id=n).collect())
    assert apply([(1, "a")], 0) == [1]
    assert apply([(2, "a"), (3, "b")], 1) == [3]
    assert apply([(2, "a"), (3, "b")], 1) == [3]
    assert apply([(4, "b")], 2) == []


def test_late_data_windows(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame(rows((1, "a"), (2, "a"), (3, "b")), SCHEMA).coalesce(1).write.parquet(src)
    q = incremental.late_tolerant_counts(incremental.read_stream(spark, src, SCHEMA), "at", ["url"]).writeStream.format("memory").queryName("late_counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.url, r.n) for r in spark.sql("SELECT url, n FROM late_counts").collect()) == [("a", 2), ("b", 1)]
    q = incremental.once_within(incremental.read_stream(spark, src, SCHEMA), "at", ["url"]).writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT * FROM once").count() == 2
