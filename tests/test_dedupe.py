import datetime as dt
import random

from pyspark.sql import functions as F

from quaymark.operators import dedupe

SCHEMA = "msg_id long, url string, ticker string, tp timestamp_ntz, extra string"
T = dt.datetime(2024, 1, 1)
IDENT = lambda: F.when(F.col("url").isNotNull(), dedupe.identifier(F.col("url"), F.col("ticker"), F.col("tp")))


def some(seed, n=300):
    rng = random.Random(seed)
    hot = ("u0", "T0", T)
    rows = []
    for i in range(n):
        u, t, at = hot if rng.random() < 0.33 else (rng.choice([None, "a", "b", "c,1:x"]), rng.choice([None, "x", "X"]), T + dt.timedelta(hours=rng.randrange(3)))
        rows.append((i, u, t, at, "e"))
    rng.shuffle(rows)
    return rows


def brute(rows, seen=()):
    first = {}
    for r in sorted(rows):
        if r[1] is not None and r[1:4] not in seen:
            first.setdefault(r[1:4], r[0])
    return first


def test_duplicates_against_brute_force(spark):
    rows = some(1)
    df = spark.createDataFrame(rows, SCHEMA)
    keep = set(brute(rows).values())
    want = sorted(r[0] for r in rows if r[1] is not None and r[0] not in keep)
    assert sorted(r.arrival for r in dedupe.duplicates(df, IDENT(), F.col("msg_id"), 4).collect()) == want
    assert dedupe.duplicates(df.limit(0), IDENT(), F.col("msg_id"), 4).count() == 0


def test_identifier_keeps_columns_apart(spark):
    df = spark.createDataFrame([("a,1:b", None), ("a", "b"), ("a", None), ("a", "")], "x string, y string")
    assert df.select(dedupe.identifier(F.col("x"), F.col("y")).alias("i")).distinct().count() == 4


def test_store_over_batches(spark, tmp_path):
    store = dedupe.SeenStore(spark, f"file://{tmp_path}/seen", shards=3, merge_after=2)
    seen = {}
    for seed in (1, 2, 3, 4):
        rows = [(r[0] + 1000 * seed, *r[1:]) for r in some(seed, 120)]
        kept = store.apply(spark.createDataFrame(rows, SCHEMA), IDENT(), F.col("msg_id")).collect()
        want = brute(rows, seen)
        assert sorted(r.msg_id for r in kept) == sorted([*want.values(), *(r[0] for r in rows if r[1] is None)])
        seen |= want
    dictionary, bits = store.state()
    assert dictionary.count() == dictionary.select("ident").distinct().count() == dictionary.select("shard", "code").distinct().count() == len(seen)
    assert bits.agg(F.sum(F.bitmap_count("bits"))).first()[0] == len(seen)
    # a batch given again passes nothing but rows without identifier
    again = store.apply(spark.createDataFrame(rows, SCHEMA), IDENT(), F.col("msg_id"))
    assert again.filter("url IS NOT NULL").count() == 0
