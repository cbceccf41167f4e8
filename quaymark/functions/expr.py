"""Casts, dates and ratios that never throw, whatever the input.

Each returns a Column; bad values give null, and ``cast_issue`` tells which values were
bad. Everything stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that vendors send for null; profiles of funds add one.
SENTINELS = ("None", "", ".")
FUND_SENTINELS = (*SENTINELS, "n/a")
#: Numbers as vendors may write them; keeps out suffixes like 1d that Spark alone would take.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def without_sentinels(c: Column | str, sentinels: Sequence[str] = SENTINELS) -> Column:
    c = _col(c)
    return F.when(~c.isin(*sentinels), c)


def number(c: Column | str) -> Column:
    """Double, or null for whatever is no plain number."""
    c = _col(c)
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def cast_issue(raw: Column, cast: Column) -> Column:
    """True where there was a value and the cast lost it."""
    return raw.isNotNull() & cast.isNull()


def lax_date(c: Column | str) -> Column:
    """Date of the first yyyy-MM-dd in a text, whatever stands around it."""
    return F.regexp_extract(F.replace(_col(c), F.lit("\n"), F.lit("")), r"\d{4}-\d{2}-\d{2}", 0).try_cast("date")


def news_stamp(c: Column | str) -> Column:
    """Timestamp of exactly yyyyMMddTHHmmss; other lengths give null."""
    c = _col(c)
    return F.when(c.rlike(r"^\d{8}T\d{6}$"), F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmss"))).cast("timestamp_ntz")


def next_page_bound(c: Column | str) -> Column:
    """Truncated to the minute, a minute on, as yyyyMMddTHHmm."""
    return F.date_format(F.date_trunc("MINUTE", _col(c)) + F.expr("INTERVAL 1 MINUTE"), "yyyyMMdd'T'HHmm")


def years_before(c: Column | str, years: int) -> Column:
    """The same day some years earlier, 29 February becoming the 28th."""
    return F.add_months(_col(c), -12 * years)


def trading_date(local: Column) -> Column:
    """Last fully traded day at a local time: the day itself at weekends and from 20:00, else the day before."""
    day = F.to_date(local)
    return F.when((F.weekday(day) >= 5) | (F.hour(local) >= 20), day).otherwise(F.date_sub(day, 1))


def month_sequence(first: Column, last: Column) -> Column:
    """First days of the months from ``first`` to ``last``; empty when they are the wrong way round or null."""
    a, b = F.trunc(first, "month"), F.trunc(last, "month")
    months = F.when(a <= b, F.sequence(a, b, F.expr("INTERVAL 1 MONTH")))
    return F.coalesce(months, F.array().cast("array<date>"))


def ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    """a / b, null for a zero divisor."""
    r = F.try_divide(a.cast("double"), b.cast("double"))
    return r if digits is None else F.round(r, digits)


def normalised(c: Column | str, mapping: Mapping[str, str], other: str = "Other") -> Column:
    """Value of a trimmed key in a fixed mapping, else ``other``."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(pairs, F.trim(_col(c))), F.lit(other))


def thousands(c: Column | str) -> Column:
    """A whole number with thousands set apart by commas; ``n/a`` for null."""
    return F.coalesce(F.format_number(_col(c), 0), F.lit("n/a"))


def signed(c: Column | str) -> Column:
    """As ``thousands``, with its sign; zero is positive."""
    c = _col(c)
    return F.when(c.isNull(), "n/a").otherwise(F.concat(F.when(c >= 0, "+").otherwise(""), F.format_number(c, 0)))


def issue_list(checks: Sequence[tuple[str, Column]]) -> Column:
    """Names of the checks that are true, joined by commas; null when none is."""
    text = F.concat_ws(",", *[F.when(test, F.lit(name)) for name, test in checks])
    return F.nullif(text, F.lit(""))


def safe_file_name(c: Column | str) -> Column:
    """A symbol as a reversible file name: everything but unreserved characters percent-encoded."""
    u = F.url_encode(_col(c))
    for a, b in (("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        u = F.replace(u, F.lit(a), F.lit(b))
    return u


def symbol_of_file(c: Column | str) -> Column:
    """Symbol in a file name ``<asset>_<encoded symbol>[_annual|_quarterly].parquet``."""
    inner = F.regexp_extract(_col(c), r"^[a-z]+_(.+?)(?:_annual|_quarterly)?\.[a-z]+$", 1)
    return F.when(inner != "", F.url_decode(inner))


def first_keyed(entries: Column, key: str, value: str, wanted: str) -> Column:
    """Value of the last entry of an array of structs whose ``key`` is ``wanted``; null if none."""
    hits = F.filter(entries, lambda e: e[key] == wanted)
    return F.get(hits, F.size(hits) - 1)[value]
