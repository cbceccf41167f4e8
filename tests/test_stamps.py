import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from quaymark.functions.stamps import with_instant


def us(*parts, zone="UTC", fold=0, extra=0):
    t = dt.datetime(*parts, tzinfo=ZoneInfo(zone), fold=fold)
    return (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1) + extra


def read(spark, cases):
    df = spark.createDataFrame([(i, s, z, "x") for i, (s, z) in enumerate(cases)], "rec long, stamp string, zone string, epoch string")
    return [r.us for r in with_instant(df, "stamp", F.col("zone"), out="us").orderBy("rec").collect()]


def test_formats(spark):
    cases = {
        "20240105T093015": us(2024, 1, 5, 9, 30, 15),
        "20240105T0930": us(2024, 1, 5, 9, 30),
        "2024-01-05": us(2024, 1, 5),
        " 2024-01-05 09:30:15.25\n": us(2024, 1, 5, 9, 30, 15, 250000),
        "2024-01-05 09:30:15,123456": us(2024, 1, 5, 9, 30, 15, 123456),
        "2024-01-05T09:30:15z": us(2024, 1, 5, 9, 30, 15),
        "2024-01-05T09:30:15+0530": us(2024, 1, 5, 4, 0, 15),
        "2024-01-05 09:30:15-05": us(2024, 1, 5, 14, 30, 15),
        "2024-01-05T09:30:15.5+02:00[Europe/Paris]": us(2024, 1, 5, 7, 30, 15, 500000),
        "2024-07-05T09:30:15[US/Eastern]": us(2024, 7, 5, 13, 30, 15),
        "2024-07-05 09:30:15 asia/tokyo": us(2024, 7, 5, 0, 30, 15),
        "2024-07-05 09:30:15 CEST": us(2024, 7, 5, 7, 30, 15),
        "Fri, 05 Jan 2024 09:30:15 +0100": us(2024, 1, 5, 8, 30, 15),
        "Fri, 05 Jan 2024 09:30:15 GMT": us(2024, 1, 5, 9, 30, 15),
        "Friday, 5 January 2024 09:30:15": us(2024, 1, 5, 9, 30, 15),
        "Fri, January 5, 2024 9:30 AM": us(2024, 1, 5, 9, 30),
        "05-Jan-2024 09:30:15": us(2024, 1, 5, 9, 30, 15),
        "01/05/2024 12:05:00 AM": us(2024, 1, 5, 0, 5),
        "01/05/2024 12:05:00 pm": us(2024, 1, 5, 12, 5),
        "05.01.2024 09:30": us(2024, 1, 5, 9, 30),
        "Jan 5, 2024 9:30:15 PM EST": us(2024, 1, 6, 2, 30, 15),
        "1704447015": us(2024, 1, 5, 9, 30, 15),
        "1704447015123": us(2024, 1, 5, 9, 30, 15, 123000),
        "1704447015123456": us(2024, 1, 5, 9, 30, 15, 123456),
        "1704447015123456789": us(2024, 1, 5, 9, 30, 15, 123456),
    }
    assert dict(zip(cases, read(spark, [(s, "UTC") for s in cases]))) == cases


def test_nothing_denoted(spark):
    bad = [None, "", " ", ".", "None", "pending", "yesterday 14:05", "T153000", "0000-00-00 00:00:00", "20241345T101500", "2023-02-29", "2024-01-05 24:00:00",
           "2024-01-05 10:60:00", "2024-01-05T09:30:15[Mars/Phobos]", "2024-01-05 09:30:15 XYZ", "13/05/2024 1:00:00 PM", "01/05/2024 13:00:00 PM", "x2024-01-05", "Xyz, 01 Jan 2024", "Mon, 05 Jan 2024 09:30:15", "Friday, Janfoo 5, 2024", "Janfoo 3, 2024", "Jan. 3, 2024", "Frida, 05 Jan 2024", "2024-01-05T09:30:15+0", "99999999999999999999999"]
    assert read(spark, [(s, "UTC") for s in bad]) == [None] * len(bad)
    assert read(spark, [("2024-01-05 09:30:00", "Nowhere/At_all"), ("2024-01-05 09:30:00", None), ("2024-01-05 09:30:00Z", None)]) == [None, None, us(2024, 1, 5, 9, 30)]


def test_daylight_saving_policy(spark):
    # twice: the first occurrence; skipped: the offset from before the change; an abbreviation decides
    got = read(spark, [("2024-11-03 01:30:00", "US/Eastern"), ("2024-11-03 01:30:00 EST", "US/Eastern"), ("2024-03-10 02:30:00", "US/Eastern"), ("2024-10-27 02:30:00", "Europe/Paris"), ("2024-03-31 01:30:00", "Europe/London")])
    assert got == [us(2024, 11, 3, 5, 30), us(2024, 11, 3, 6, 30), us(2024, 3, 10, 7, 30), us(2024, 10, 27, 0, 30), us(2024, 3, 31, 1, 30)]


def test_every_hour_of_a_year_against_zone_data(spark):
    zones = ("US/Eastern", "Europe/London", "Europe/Paris", "Asia/Tokyo")
    walls = [dt.datetime(2024, 1, 1, 0, 17) + dt.timedelta(hours=h) for h in range(0, 8784, 3)]
    cases = [(w.strftime("%Y-%m-%d %H:%M:%S"), z) for z in zones for w in walls]
    want = [us(*w.timetuple()[:6], zone=z) for z in zones for w in walls]
    assert read(spark, cases) == want


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "2024-01-05", "UTC", "keep")], "rec long, stamp string, zone_id string, zone_key string")
    out = with_instant(df, "stamp", F.col("zone_id"), out="us")
    assert out.columns == ["rec", "stamp", "zone_id", "zone_key", "us"] and out.first().us == us(2024, 1, 5)
    assert with_instant(df.limit(0), "stamp", F.lit("UTC"), out="us").count() == 0
