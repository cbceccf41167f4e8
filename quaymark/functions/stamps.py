"""One instant from stamps written in many formats, precisions and zones.

An ordered cascade of anchored patterns takes a stamp apart, strict checks turn the
parts into a local time, and the zone comes from the text, else from the source's
default zone by lookup. All of it is JVM-side expressions.

Policies, which hold everywhere:

* a zone or offset inside the text goes before the default zone;
* a wall time that occurs twice is its first occurrence, one that was skipped is read
  with the offset from before the change;
* slashed dates are month first, dotted dates day first; a date alone is its
  midnight; a value without seconds has second 0;
* all-digit texts count from 1970-01-01 UTC, in seconds up to 11 digits, milliseconds
  up to 14, microseconds up to 17, nanoseconds up to 19;
* a month or weekday is named whole or by its first three letters, and a weekday must be that of its date;
* white space around a stamp does not count; anything that no pattern takes as a
  whole, any date or time that does not exist (24:00 and leap seconds too), an unknown zone or
  abbreviation, and null give null.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of months and weekdays in the stamps, whole or by their first letters, and hours of offset of the abbreviations of
#: North America, Western Europe and Japan.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0, "WEST": 1, "BST": 1, "IST": 1, "CET": 1, "CEST": 2, "MET": 1, "MEST": 2, "JST": 9,
    "NST": -3.5, "NDT": -2.5, "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "AKST": -9, "AKDT": -8, "HST": -10,
}

_ZONE = r"\s*([Zz]|[+-]\d{2}(?::?\d{2})?(?:\[[^\]]*\])?|[A-Za-z]{2,5}|\[?[A-Za-z_]+(?:/[A-Za-z0-9_+-]+)+\]?)?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_HALF = r"\s*([AaPp][Mm])?"
_NAMES = "(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in MONTHS) + ")"
_WEEKDAYS = "(" + "|".join(f"{d[:3]}(?:{d[3:]})?" for d in WEEKDAYS) + ")"

#: Pattern and the groups of year, month, day, hour, minute, second, fraction, half day, zone, weekday in it.
CASCADE = (
    (r"^(\d{4})-(\d{2})-(\d{2})(?:[T ]" + _CLOCK + _ZONE + ")?$", (1, 2, 3, 4, 5, 6, 7, 0, 8, 0)),
    (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,9}))?)?" + _ZONE + "$", (1, 2, 3, 4, 5, 6, 7, 0, 8, 0)),
    (r"^(?:" + _WEEKDAYS + r", )?(\d{1,2})[ -]" + _NAMES + r"[ -](\d{4})(?: " + _CLOCK + _ZONE + ")?$", (4, 3, 2, 5, 6, 7, 8, 0, 9, 1)),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:,? " + _CLOCK + _HALF + _ZONE + ")?$", (3, 1, 2, 4, 5, 6, 7, 8, 9, 0)),
    (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})(?:,? " + _CLOCK + _HALF + _ZONE + ")?$", (3, 2, 1, 4, 5, 6, 7, 8, 9, 0)),
    (r"^(?:" + _WEEKDAYS + r", )?" + _NAMES + r" (\d{1,2}), (\d{4})(?:,? " + _CLOCK + _HALF + _ZONE + ")?$", (4, 2, 3, 5, 6, 7, 8, 9, 10, 1)),
)
_PARTS = ("y", "mo", "d", "h", "mi", "s", "fr", "half", "zone", "weekday")


def _take_apart(text: Column) -> Column:
    """The parts joined by ``|`` by the first pattern that takes the whole text, else null."""
    taken = F.lit(None).cast("string")
    for pattern, groups in reversed(CASCADE):
        joined = F.regexp_replace(text, pattern, "|".join(f"${g}" if g else "" for g in groups))
        taken = F.when(text.rlike(pattern), joined).otherwise(taken)
    return taken


def _epoch(text: Column) -> Column:
    n = text.try_cast("decimal(20,0)")
    size = F.length(text)
    us = F.when(size <= 11, n * 1_000_000).when(size <= 14, n * 1000).when(size <= 17, n).when(size <= 19, F.floor(n / 1000))
    return us.try_cast("bigint")


def zone_lookup(spark: SparkSession) -> DataFrame:
    """Zone names known to both Python's and Spark's zone data, by lower case: ``zone_key``, ``zone_id``.

    Some 600 rows whatever the input, which is why it may be broadcast.
    """
    known = set(spark._jvm.java.time.ZoneId.getAvailableZoneIds().toArray()) & available_timezones()
    return spark.createDataFrame(sorted((z.lower(), z) for z in known), "zone_key string, zone_id string")


def with_instant(df: DataFrame, stamp: str, default_zone: Column, out: str = "epoch_us", prefix: str = "__stamp_") -> DataFrame:
    """``df`` with ``out``, the microseconds since 1970-01-01 UTC that ``stamp`` denotes, or null.

    ``default_zone`` is the zone of stamps without one; if it is itself no known zone
    such stamps denote nothing. All columns of ``df`` stay; helper columns carry
    ``prefix`` and are dropped again.
    """
    p = prefix
    text = F.regexp_replace(F.col(f"`{stamp}`"), r"^\s+|\s+$", "")
    df = df.withColumn(f"{p}t", text).withColumn(f"{p}p", F.split(_take_apart(F.col(f"{p}t")), r"\|"))
    part = {k: F.get(F.col(f"{p}p"), F.lit(i)) for i, k in enumerate(_PARTS)}
    month = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(part["mo"], 1, 3)).cast("int"), F.lit(0)), part["mo"].try_cast("int"))
    day = F.concat_ws("-", part["y"], F.lpad(month.cast("string"), 2, "0"), F.lpad(part["d"], 2, "0")).try_cast("date")
    num = {k: F.coalesce(F.nullif(part[k], F.lit("")).try_cast("int"), F.lit(0)) for k in ("h", "mi", "s")}
    pm, halved = F.lower(part["half"]) == "pm", part["half"] != ""
    hour = F.when(halved, num["h"] % 12 + F.when(pm, 12).otherwise(0)).otherwise(num["h"])
    named = (part["weekday"] == "") | (F.weekday(day) + 1 == F.array_position(F.array(*[F.lit(d[:3]) for d in WEEKDAYS]), F.substring(part["weekday"], 1, 3)))
    sane = F.when(halved, num["h"].between(1, 12)).otherwise(num["h"] < 24) & (num["mi"] < 60) & (num["s"] < 60)
    fraction = F.rpad(F.substring(part["fr"], 1, 6), 6, "0").cast("bigint")
    seconds = F.unix_date(day).cast("bigint") * 86400 + hour * 3600 + num["mi"] * 60 + num["s"]
    df = df.withColumns({f"{p}us": F.when(named & sane, seconds * 1_000_000 + fraction), f"{p}z": part["zone"]})

    zone = F.col(f"{p}z")
    offset = r"^([+-])(\d{2}):?(\d{2})?.*$"
    sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
    hh, mm = F.regexp_extract(zone, offset, 2).try_cast("int"), F.coalesce(F.regexp_extract(zone, offset, 3).try_cast("int"), F.lit(0))
    fixed = F.when(zone.rlike(r"^[+-]"), F.when((hh <= 18) & (mm < 60), sign * (hh * 3600 + mm * 60)))
    for short, hours in ABBREVIATIONS.items():
        fixed = fixed.when(F.upper(zone) == short, int(hours * 3600))
    key = F.when(zone == "", F.lower(F.trim(default_zone))).when(zone.contains("/"), F.lower(F.translate(zone, "[]", "")))
    lookup = zone_lookup(df.sparkSession).select(F.col("zone_key").alias(f"{p}k"), F.col("zone_id").alias(f"{p}id"))
    df = df.withColumns({f"{p}off": fixed.cast("bigint"), f"{p}k": key}).join(F.broadcast(lookup), f"{p}k", "left")
    local = F.col(f"{p}us")
    instant = (
        F.when(F.col(f"{p}t").rlike(r"^\d+$"), _epoch(F.col(f"{p}t")))
        .when(F.col(f"{p}off").isNotNull(), local - F.col(f"{p}off") * 1_000_000)
        .when(F.col(f"{p}id").isNotNull(), F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), F.col(f"{p}id"))))
    )
    return df.withColumn(out, instant).drop(*[f"{p}{x}" for x in ("t", "p", "us", "z", "k", "off", "id")])
