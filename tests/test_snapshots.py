import datetime as dt
import random

from pyspark.sql import functions as F

from quaymark.operators import snapshots

SCHEMA = "snapshot_date date, symbol string, name string, sector string, ipoDate date, delistingDate date, status string, loaded_at timestamp_ntz, snap int"
D = [dt.date(2024, 1, d) for d in (5, 12, 19, 26)]


def row(day, symbol, name="N", sector="S", status="Active", at=None, ipo=None):
    return (D[day], symbol, name, sector, ipo, None, status, at or dt.datetime(2024, 1, D[day].day, 21), 7)


def changes(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = snapshots.found_changes({"stocks": (df, ("name", "sector", "ipoDate", "delistingDate", "status"))}).collect()
    return sorted((r.snapshot_date, r.symbol, r.change) for r in out)


def test_changes_and_noise(spark):
    rows = [
        row(0, "A"), row(1, " a\t", name=" n "), row(2, "A", name="M"),
        row(0, "B"), row(2, "B"),
        row(1, "C", status="None"), row(2, "C", status=None),
        row(0, None), row(1, "null"), row(1, ""),
        # the later load stands
        row(1, "D", name="old"), row(1, "D", name="new", at=dt.datetime(2024, 1, 13)), row(2, "D", name="new"),
    ]
    assert changes(spark, rows) == [
        ("2024-01-12", "B", "removed"), ("2024-01-12", "C", "added"), ("2024-01-12", "D", "added"),
        ("2024-01-19", "A", "changed"), ("2024-01-19", "B", "added"),
    ]


def test_null_and_empty_differ_only_by_value(spark):
    # a value that moves to the neighbouring column is a change
    rows = [row(0, "A", name="x", sector=None), row(1, "A", name=None, sector="x")]
    assert changes(spark, rows) == [("2024-01-12", "A", "changed")]


def test_empty_table_and_single_snapshot(spark):
    assert changes(spark, []) == []
    assert changes(spark, [row(0, "A")]) == []


def brute_history(rows):
    best = {}
    for r in rows:
        if r[1]:
            k = (r[0], r[1])
            if k not in best or r[7] > best[k][7]:
                best[k] = r
    days = sorted({k[0] for k in best})
    out = []
    for s in sorted({k[1] for k in best}):
        run = None
        for i, d in enumerate(days):
            r = best.get((d, s))
            v = (r[2], r[3], r[6]) if r else None
            if run and v != run[1]:
                out.append((s, run[0], d))
                run = None
            if v and not run:
                run = (d, v)
        if run:
            out.append((s, run[0], dt.date(9999, 12, 31)))
    return sorted(out)


def test_history_against_brute_force_with_late_rows(spark):
    rng = random.Random(5)
    rows = []
    for s in "ABCDEFGH":
        for day in range(4):
            if rng.random() < 0.75:
                late = rng.random() < 0.3
                at = dt.datetime(2024, 2, 1, rng.randrange(20)) if late else dt.datetime(2024, 1, D[day].day, 21, rng.randrange(60))
                rows.append(row(day, s, name=rng.choice("xy"), at=at))
                if rng.random() < 0.3:
                    rows.append(row(day, s, name=rng.choice("xy"), at=dt.datetime(2024, 3, 1, rng.randrange(20), rng.randrange(60))))
    df = spark.createDataFrame(rows, SCHEMA)
    got = snapshots.history(df, ("name", "sector", "delistingDate", "status"))
    assert sorted((r.symbol, r.valid_from, r.valid_to) for r in got.collect()) == brute_history(rows)
    assert snapshots.history(df.limit(0), ("name",)).count() == 0


def test_whole_snapshot_that_came_late_splits_chains(spark):
    # the middle snapshot was not known when the chains were built, and A is not in it
    rows = [row(0, "A"), row(2, "A"), row(0, "B"), row(2, "B"), row(1, "B", at=dt.datetime(2024, 2, 1))]
    got = snapshots.history(spark.createDataFrame(rows, SCHEMA), ("name", "sector", "status"))
    assert sorted((r.symbol, r.valid_from, r.valid_to) for r in got.collect()) == [("A", D[0], D[1]), ("A", D[2], dt.date(9999, 12, 31)), ("B", D[0], dt.date(9999, 12, 31))]


def test_untouched_chains_pass_through(spark):
    rows = snapshots.latest_rows(spark.createDataFrame([row(0, "A"), row(1, "A"), row(0, "B")], SCHEMA), ("name",), keep_values=True)
    days = snapshots.calendar(rows)
    chains = snapshots.build_chains(rows, days).withColumn("valid_to", F.lit(dt.date(2000, 1, 1)))
    got = {r.sym: r.valid_to for r in snapshots.rebuild_affected(chains, rows, rows.filter("sym = 'B'").select("sym"), days).collect()}
    assert got == {"A": dt.date(2000, 1, 1), "B": D[1]}


def test_store_takes_deliveries_in_any_order(spark, tmp_path):
    rng = random.Random(11)
    attributes = ("name", "sector", "delistingDate", "status")
    rows = [row(day, s, name=rng.choice("xy")) for s in "ABCDE" for day in range(4) if rng.random() < 0.7]
    corrected = [row(day, "A", name="z", at=dt.datetime(2024, 5, 1)) for day in (1, 2)]
    store = snapshots.HistoryStore(spark, f"file://{tmp_path}/h", attributes, buckets=3)
    seen = []
    for number, part in enumerate(([r for r in rows if r[0] in (D[0], D[2])], [r for r in rows if r[0] == D[3]], [r for r in rows if r[0] == D[1]], corrected)):
        seen += part
        store.deliver(spark.createDataFrame(part, SCHEMA), number)
        assert sorted((r.symbol, r.valid_from, r.valid_to) for r in store.read().collect()) == brute_history(seen)
    store.deliver(spark.createDataFrame(corrected, SCHEMA), 3)
    assert sorted((r.symbol, r.valid_from, r.valid_to) for r in store.read().collect()) == brute_history(seen)
    # given again under its number with other rows: what it no longer lists is rebuilt too
    store.deliver(spark.createDataFrame(corrected[:1], SCHEMA), 3)
    assert sorted((r.symbol, r.valid_from, r.valid_to) for r in store.read().collect()) == brute_history([*rows, *corrected[:1]])


def test_ordinary_deliveries_rebuild_nothing_and_late_ones_only_what_they_touch(spark, tmp_path):
    symbols = [f"S{i}" for i in range(40)]
    store = snapshots.HistoryStore(spark, f"file://{tmp_path}/h", ("name",), buckets=4, merge_after=2)
    rows = [row(0, s, name="x") for s in symbols]
    assert store.deliver(spark.createDataFrame(rows, SCHEMA), 0) == 0
    for day in (1, 2, 3):
        part = [row(day, s, name="y" if (k + day) % 7 == 0 else "x") for k, s in enumerate(symbols) if k % 11 != day]
        rows += part
        assert store.deliver(spark.createDataFrame(part, SCHEMA), day) == 0
    before = store.current()
    late = [row(1, "S1", name="z", at=dt.datetime(2024, 5, 1)), row(2, "S9", name="z", at=dt.datetime(2024, 5, 1))]
    rows += late
    assert store.deliver(spark.createDataFrame(late, SCHEMA), 4) == 2
    after = store.current()
    assert sum(before["open"].get(b) != after["open"].get(b) for b in set(before["open"]) | set(after["open"])) <= 2
    want = [(s, a, b) for s, a, b in brute_history(rows)]
    assert sorted((r.symbol, r.valid_from, r.valid_to) for r in store.read().collect()) == want
