"""Implausible readings, judged against the source's own normal behaviour.

Spikes are found by phase-space thresholding: a reading's distance from the local level, its
first and its second difference are points in three planes, each with an ellipse whose axes are robust
scales times the universal threshold; that of distance and second difference lies along the
principal axis of its points. Points outside an ellipse are suspects. A spike throws its
neighbours out of the ellipses of the differences too, so those are
taken that are at least half as far from the local level as any such point near them. They are
replaced by that level and the search is repeated until it finds nothing new. Runs without any difference catch stuck values,
bounds catch impossible ones, and a split is held against the level it claims to move.

Series are cut into blocks with a margin on both sides, daily readings by calendar and
minutes by the days that have any; after redeliveries are collapsed (an aggregation with
map-side combine) a block holds at most one reading per stamp, so no source makes an
unbounded group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaymark.session import heavy_partitions

#: Rows of the moving median that is the local level; spikes of up to (LEVEL - 1) / 2 rows don't move it.
LEVEL = 11
#: A spike is back at its former level within so many rows.
LONGEST_SPIKE = 3
#: A spike reaches the central second differences of so many rows beside it.
REACH = LONGEST_SPIKE + 1
#: Times the universal threshold sqrt(2 ln n); market data has heavier tails than the normal noise that was derived for.
FACTOR = 3.0
#: Normal move, on a log scale, of a series that moves too rarely to show one.
LEAST_SCALE = 1e-3
#: Shortest run of equal values that can be a stuck reading, and by how much it must exceed the longest run expected of the source.
SHORTEST_RUN, RUN_MARGIN = 5, 1.5
#: Days of a block of daily readings, and of its margins.
BLOCK_DAYS, MARGIN_DAYS = 1024, 128
#: Days with readings of a block of minutes, and of its margins; a margin of eight gives every block of a longer series eight readings.
MINUTE_BLOCK, MINUTE_MARGIN = 16, 8


def local_level(x: np.ndarray, width: int = LEVEL) -> np.ndarray:
    """Moving median, the ends mirrored."""
    half = min(width // 2, len(x) - 1)
    padded = np.pad(x, half, mode="reflect")
    return np.median(np.lib.stride_tricks.sliding_window_view(padded, 2 * half + 1), axis=1)


def _scale(x: np.ndarray) -> float:
    return 1.4826 * float(np.median(np.abs(x - np.median(x)))) if len(x) else 0.0


def outside_ellipses(u: np.ndarray, kept: np.ndarray, limit: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masks of the points outside each of the three ellipses of phase space: value and first, first and second, value and second difference.

    ``u`` is the distance from the local level; differences are central. Scales are those of the ``kept``
    points, at least those of a walk whose distances have scale ``least``. The ellipse of ``u`` and its second difference is turned by the angle of their
    principal axis, its axes being those whose projections are the two scales.
    """
    d1 = np.gradient(u)
    d2 = np.gradient(d1)
    su = max(_scale(u[kept]), least)
    s1, s2 = max(_scale(d1[kept]), least), max(_scale(d2[kept]), least / math.sqrt(2))
    a, b, c = u / (limit * su), d1 / (limit * s1), d2 / (limit * s2)
    angle = math.atan2(float((u * d2)[kept].sum()), max(float((u * u)[kept].sum()), 1e-300))
    cos, sin = math.cos(angle), math.sin(angle)
    spread = cos**4 - sin**4
    long, short = (su * su * cos * cos - s2 * s2 * sin * sin, s2 * s2 * cos * cos - su * su * sin * sin)
    if spread > 0 and long > 0 and short > 0:
        turned = ((u * cos + d2 * sin) ** 2 / long + (d2 * cos - u * sin) ** 2 / short) * spread / limit**2
    else:  # scales that no turned ellipse has
        turned = a * a + c * c
    return a * a + b * b > 1, b * b + c * c > 1, turned > 1


def _farthest(outside: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The points outside that are at least half as far from the level as any other outside within ``REACH`` rows."""
    far = np.where(outside, np.abs(u), 0.0)
    near = np.lib.stride_tricks.sliding_window_view(np.pad(far, REACH), 2 * REACH + 1).max(axis=1)
    return outside & (far >= near / 2)


def phase_space_spikes(x: np.ndarray, factor: float = FACTOR) -> np.ndarray:
    """Mask of the spikes in a series of finite values on an additive scale.

    Series of fewer than eight readings have no normal behaviour to be judged by and
    no spikes. A spike is at most ``LONGEST_SPIKE`` rows long and lies between rows of
    the same level; at an end of the series, where one side is missing, it must be
    twice as far from the level as the ellipses allow.
    """
    n = len(x)
    suspects = np.zeros(n, dtype=bool)
    if n < 8:
        return suspects
    limit = factor * math.sqrt(2 * math.log(n))
    clean = x.copy()
    while True:  # suspects only grow, so this ends
        level = local_level(clean)
        u = x - level
        kept = ~suspects
        moves = np.diff(clean)
        moves = moves[moves != 0]
        # a source that often repeats its value shows its normal moves only when it moves; one that hardly moves shows none
        usual = _scale(moves) / math.sqrt(2) if len(moves) >= n / 5 else LEAST_SCALE
        least = max(usual, 1e-9)
        far = np.abs(u) / (limit * max(_scale(u[kept]), least))
        # the points that are suspects already must not hide their neighbours' differences
        outside = np.any(outside_ellipses(np.where(suspects, 0.0, u), kept, limit, least), axis=0)
        fresh = _farthest(outside, u) & ~suspects
        if not fresh.any():
            break
        suspects |= fresh
        clean = np.where(suspects, level, x)
    spikes = np.zeros(n, dtype=bool)
    i = 0
    while i < n:
        if not suspects[i]:
            i += 1
            continue
        j = i
        while j + 1 < n and suspects[j + 1]:
            j += 1
        before, after = clean[max(0, i - 3) : i], clean[j + 1 : j + 4]
        if j - i < LONGEST_SPIKE:
            if len(before) and len(after):
                jump = np.abs(x[i : j + 1] - np.median(before)).min()
                spikes[i : j + 1] = abs(np.median(before) - np.median(after)) < jump / 2
            else:
                spikes[i : j + 1] = bool((far[i : j + 1] > 2).all())
        i = j + 1
    return spikes


def stuck_runs(x: np.ndarray) -> np.ndarray:
    """Mask of the repeats (all but the first) in runs far longer than the series otherwise shows.

    How often the source repeats itself is taken from its shorter runs; a geometric law then
    gives the longest run to expect in a series of this length.
    """
    n = len(x)
    out = np.zeros(n, dtype=bool)
    if n < SHORTEST_RUN:
        return out
    edges = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    lengths = np.diff(np.append(edges, n))
    usual = lengths[lengths <= SHORTEST_RUN]
    p = (usual - 1).sum() / max(1, usual.sum())
    expected = math.log(max(2.0, n * (1 - p))) / math.log(1 / p) if p > 0 else 1.0
    shortest = max(SHORTEST_RUN, expected + RUN_MARGIN)
    for start, length in zip(edges, lengths):
        if length >= shortest:
            out[start + 1 : start + length] = True
    return out


def false_splits(close: np.ndarray, coefficient: np.ndarray, spikes: np.ndarray) -> np.ndarray:
    """Mask of the coefficients other than 1 that the Close of the day doesn't follow.

    ``close`` is the log of Close with NaN where there is none. The level before and
    from the day on are medians of up to three readings that are no spikes; the move
    between them must be nearer to the coefficient's than to none.
    """
    out = np.zeros(len(close), dtype=bool)
    good = np.isfinite(close) & ~spikes
    for i in np.flatnonzero(np.isfinite(coefficient) & (coefficient > 0) & (coefficient != 1)):
        before, after = close[:i][good[:i]][-3:], close[i:][good[i:]][:3]
        if len(before) and len(after):
            claimed, moved = math.log(coefficient[i]), float(np.median(before) - np.median(after))
            out[i] = abs(moved - claimed) >= abs(moved)
    return out


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of (tbl, bar_id, field) from blocks of parallel arrays."""
    for batch in batches:
        found: list[tuple[str, int, str]] = []
        for tbl, at, ids, own, first, second, third in zip(*(batch[c] for c in ("tbl", "at", "ids", "own", "v1", "v2", "v3"))):
            order = np.lexsort((ids, at))
            ids, own = np.asarray(ids)[order], np.asarray(own, dtype=bool)[order]
            values = [np.asarray(v, dtype=float)[order] for v in (first, second, third)]
            names = ("Close", "Volume") if tbl == "prices_daily" else ("High",)
            logs, masks = {}, {}
            for name, v in zip(names, values):
                usable = np.isfinite(v) & ((v >= 0) if name == "Volume" else (v > 0))
                log = np.full(len(v), np.nan)
                log[usable] = np.log1p(v[usable]) if name == "Volume" else np.log(v[usable])
                mask = np.zeros(len(v), dtype=bool)
                mask[usable] = phase_space_spikes(log[usable])
                logs[name], masks[name] = log, mask.copy()
                if tbl == "prices_daily":
                    present = np.isfinite(v)
                    mask[present] |= stuck_runs(v[present])
                found += [(tbl, int(i), name) for i in ids[mask & own]]
            if tbl == "prices_daily":
                wrong = false_splits(logs["Close"], values[2], masks["Close"])
                found += [(tbl, int(i), "SplitCoefficient") for i in ids[wrong & own]]
        yield pd.DataFrame(found, columns=["tbl", "bar_id", "field"])


def _standing(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """First delivery per symbol and Date: ``symbol``, ``at``, ``bar_id`` and the values."""
    row = F.struct("folder_date", "bar_id", *[F.col(v).cast("double").alias(v) for v in values])
    keyed = df.filter("symbol IS NOT NULL AND Date IS NOT NULL").groupBy("symbol", F.col("Date").alias("at")).agg(F.min(row).alias("r"))
    return keyed.select("symbol", "at", "r.bar_id", *[f"r.{v}" for v in values])


def implausible_readings(daily: DataFrame, minutes: DataFrame) -> DataFrame:
    """Fields of daily and minute bars that can't be right: ``tbl``, ``bar_id``, ``field``.

    Spikes and stuck values of daily Close and Volume, spikes of minute High, splits the
    Close doesn't follow, and values that can't exist (Close, High or SplitCoefficient
    not above 0, Volume below 0, High below Low). Null and NaN are missing, never wrong.
    Of readings delivered again only the first delivery (by folder date, then bar_id) is
    judged. Rows without symbol or Date are judged by the bounds only.
    """
    d = _standing(daily, ("Close", "Volume", "SplitCoefficient"))
    m = _standing(minutes, ("High", "Low"))
    nan = F.lit(float("nan"))
    day = F.unix_date(F.to_date("at"))
    block = lambda at, days, shift: F.floor((at + shift) / days)
    blocks = lambda at, days, margin: F.explode(F.array_distinct(F.array(*(block(at, days, x) for x in (-margin, 0, margin)))))
    d_blocks = d.withColumn("block", blocks(day, BLOCK_DAYS, MARGIN_DAYS)).select(
        F.lit("prices_daily").alias("tbl"), "symbol", "block", F.col("at").cast("timestamp_ntz").alias("at"), "bar_id", (F.col("block") == block(day, BLOCK_DAYS, 0)).alias("own"),
        F.coalesce("Close", nan).alias("v1"), F.coalesce("Volume", nan).alias("v2"), F.coalesce("SplitCoefficient", nan).alias("v3"),
    )
    usable = m.filter((F.col("High") > 0) & (F.col("High") < float("inf"))).withColumn("day", day)
    # a symbol's days are as many as the calendar has
    numbered = usable.select("symbol", "day").distinct().withColumn("no", F.row_number().over(Window.partitionBy("symbol").orderBy("day")) - 1)
    no = F.col("no")
    m_blocks = usable.join(numbered, ["symbol", "day"]).withColumn("block", blocks(no, MINUTE_BLOCK, MINUTE_MARGIN)).select(
        F.lit("prices").alias("tbl"), "symbol", "block", F.col("at").cast("timestamp_ntz").alias("at"), "bar_id", (F.col("block") == block(no, MINUTE_BLOCK, 0)).alias("own"),
        F.coalesce("High", nan).alias("v1"), nan.alias("v2"), nan.alias("v3"),
    )
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("at"))
    series = (
        d_blocks.unionByName(m_blocks)
        .repartition(heavy_partitions(daily.sparkSession), "tbl", "symbol", "block")
        .groupBy("tbl", "symbol", "block")
        .agg(F.collect_list(micros).alias("at"), F.collect_list("bar_id").alias("ids"), *[F.collect_list(c).alias(c) for c in ("own", "v1", "v2", "v3")])
    )
    judged = series.mapInPandas(_judge, "tbl string, bar_id long, field string")

    loose_d = daily.filter("symbol IS NULL OR Date IS NULL").select("bar_id", *[F.col(c).cast("double").alias(c) for c in ("Close", "Volume", "SplitCoefficient")])
    loose_m = minutes.filter("symbol IS NULL OR Date IS NULL").select("bar_id", *[F.col(c).cast("double").alias(c) for c in ("High", "Low")])
    bad = lambda test, field: F.when(test, F.lit(field))
    d_bad = F.array_compact(F.array(bad(F.col("Close") <= 0, "Close"), bad(F.col("Volume") < 0, "Volume"), bad(F.col("SplitCoefficient") <= 0, "SplitCoefficient")))
    m_bad = F.array_compact(F.array(bad((F.col("High") <= 0) | ((F.col("High") < F.col("Low")) & ~F.isnan("Low")), "High")))
    outside = (
        d.select("bar_id", "Close", "Volume", "SplitCoefficient").unionByName(loose_d).select(F.lit("prices_daily").alias("tbl"), "bar_id", F.explode(d_bad).alias("field"))
    ).unionByName(m.select("bar_id", "High", "Low").unionByName(loose_m).select(F.lit("prices").alias("tbl"), "bar_id", F.explode(m_bad).alias("field")))
    return judged.unionByName(outside).distinct()
