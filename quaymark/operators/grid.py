"""Irregular readings onto a regular grid, gaps filled and marked.

Readings are bucketed to minutes per source and calendar day, and what is missing between the
first and the last usable minute of a day is imputed by iterative singular-spectrum
analysis: the series is embedded in a Hankel matrix, its leading singular vectors
rebuild the trajectories, the missing entries take the rebuilt values, and this is
repeated until they no longer move. Level and number of vectors are chosen once per series, so
every repetition lowers the same distance and the entries settle. Two things shorten the way to the same
entries: the singular vectors start from those of the repetition before, and the entries are extrapolated from
the last two repetitions (a secant step, bounded). An entry counts as settled only where a repetition with singular vectors from
scratch leaves it; a series that still moves after ``ROUNDS`` repetitions is marked.

A source's day has at most 1,440 minutes after bucketing, and bucketing is an
aggregation with map-side combine, so no hot source makes a large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymark.session import heavy_partitions

GRID = "symbol string, day date, minute_of_day int, Close double, Volume double, filled boolean, volume_filled boolean, unsettled boolean, volume_unsettled boolean"
#: Repetitions after which a series counts as one that doesn't settle.
ROUNDS = 20_000
#: So many moves of a repetition may be taken at once, as many more after every hundred repetitions: entries that settle late move ever less.
TRUST = 3.0


def settle(values: np.ndarray, missing: np.ndarray, window: int = 60, rank: int = 6, energy: float = 0.95, tolerance: float = 1e-3, rounds: int = ROUNDS) -> tuple[np.ndarray, bool]:
    """``values`` with the entries under ``missing`` replaced, and whether they settled.

    Starts from linear interpolation (the nearest known value at the ends). The window
    is at most a third of the series; the fewest singular vectors that carry ``energy``
    of the variance of that start are kept throughout, ``rank`` at most. Iteration ends when no
    replaced entry moves by more than ``tolerance`` standard deviations, or unsettled after
    ``rounds``. Series with fewer than three known values or six entries stay interpolated;
    one without known values stays NaN.
    """
    known = ~missing
    out = values.astype(float).copy()
    if not missing.any():
        return out, True
    if not known.any():
        out[:] = np.nan
        return out, True
    at = np.arange(len(out))
    out[missing] = np.interp(at[missing], at[known], out[known])
    n = len(out)
    if known.sum() < 3 or n < 6:
        return out, True
    scale = out[known].std()
    if not np.isfinite(scale) or scale == 0:
        return out, True
    rows = max(2, min(window, n // 3))
    cols = n - rows + 1
    weights = np.minimum(np.minimum(np.arange(1, n + 1), np.arange(n, 0, -1)), min(rows, cols)).astype(float)
    mean, gaps = out.mean(), np.flatnonzero(missing)

    def rebuilt(basis: np.ndarray, hankel: np.ndarray) -> np.ndarray:
        # the antidiagonal sums of a product of two vectors are their convolution
        return (sum(np.convolve(u, v) for u, v in zip(basis.T, basis.T @ hankel)) / weights + mean)[gaps]

    basis, scratch = None, True
    before: tuple[np.ndarray, np.ndarray, float] | None = None
    for round_no in range(rounds):
        hankel = np.lib.stride_tricks.sliding_window_view(out - mean, cols)
        gram = hankel @ hankel.T
        if scratch:
            power, vectors = np.linalg.eigh(gram)
            if basis is None:
                power = power[::-1].clip(min=0)
                total = power.sum()
                keep = 1 if total == 0 else min(rank, int(np.searchsorted(np.cumsum(power) / total, energy)) + 1)
            basis = vectors[:, ::-1][:, :keep]
        else:
            basis = np.linalg.qr(gram @ (gram @ basis))[0]
        here = out[gaps]
        fresh = rebuilt(basis, hankel)
        move = fresh - here
        moved = np.abs(move).max()
        if moved <= tolerance * scale:
            out[gaps] = fresh
            if scratch:
                return out, True
            scratch = True
            before = None
            continue
        scratch = False
        size = float(np.linalg.norm(move))
        if before is not None and size < 2 * before[2]:
            turn = move - before[1]
            further = (before[0] - fresh) * (float(turn @ move) / max(float(turn @ turn), 1e-300))
            # no further than TRUST moves at once: there are other sets of entries that no repetition moves, beyond the ones that this way leads to
            ahead = fresh + further * min(1.0, TRUST * (1 + round_no / 100) * size / max(float(np.linalg.norm(further)), 1e-300))
        else:
            ahead = fresh
        before, fresh = (fresh, move, size), ahead
        out[gaps] = fresh
    return out, False


def impute(values: np.ndarray, missing: np.ndarray, **options) -> np.ndarray:
    """``values`` with the entries under ``missing`` replaced, as by ``settle``."""
    return settle(values, missing, **options)[0]


def _fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = []
        for symbol, day, minutes, closes, volumes in zip(*(batch[c] for c in ("symbol", "day", "minutes", "closes", "volumes"))):
            minutes = np.asarray(minutes, dtype=int)
            first, n = minutes.min(), minutes.max() - minutes.min() + 1
            close, volume, there = np.full(n, np.nan), np.full(n, np.nan), np.zeros(n, dtype=bool)
            close[minutes - first], volume[minutes - first], there[minutes - first] = closes, volumes, True
            # an infinite reading is usable, but no basis for its neighbours
            smooth, settled = settle(np.where(np.isfinite(close), close, 0.0), ~np.isfinite(close))
            close = np.where(there, close, smooth)
            no_volume = ~np.isfinite(volume)
            smooth, volume_settled = settle(np.where(no_volume, 0.0, volume), no_volume)
            volume = np.where(no_volume, smooth.clip(min=0), volume)
            parts.append(
                pd.DataFrame(
                    {"symbol": symbol, "day": day, "minute_of_day": np.arange(first, first + n, dtype=np.int32), "Close": close, "Volume": volume, "filled": ~there, "volume_filled": no_volume}
                    | {"unsettled": ~there & (not settled), "volume_unsettled": no_volume & (not volume_settled)}
                )
            )
        if parts:
            yield pd.concat(parts, ignore_index=True)


def minute_grid(bars: DataFrame) -> DataFrame:
    """One row per symbol, day and minute between the day's first and last usable reading.

    ``bars`` has ``bar_id``, ``symbol``, ``Date`` (wall time), ``Close``, ``Volume`` and ``folder_date``. A
    reading is usable when its Close is neither null nor NaN. Of a stamp delivered
    twice the later delivery stands (then the larger bar_id); a minute's Close is that
    of its last stamp, its Volume the sum over its stamps. ``filled`` marks minutes
    without usable reading, ``volume_filled`` those whose Volume was imputed; ``unsettled`` and
    ``volume_unsettled`` are those among them whose imputation didn't settle. Rows
    without symbol or Date, and days without usable reading, give nothing. A day whose
    volumes are all missing has null volumes. Columns: ``symbol``, ``minute`` (text,
    yyyy-MM-dd HH:mm), ``Close``, ``Volume``, ``filled``, ``volume_filled``, ``unsettled``,
    ``volume_unsettled``.
    """
    usable = bars.filter("symbol IS NOT NULL AND Date IS NOT NULL AND Close IS NOT NULL AND NOT isnan(Close)")
    at = F.col("Date").cast("timestamp_ntz")
    standing = usable.groupBy("symbol", at.alias("at")).agg(
        F.max(F.struct("folder_date", "bar_id", F.col("Close").cast("double").alias("c"), F.col("Volume").cast("double").alias("v"))).alias("r")
    )
    minute = (F.hour("at") * 60 + F.minute("at")).alias("m")
    volume = F.when(F.col("r.v").isNotNull() & ~F.isnan("r.v"), F.col("r.v"))
    by_minute = standing.groupBy("symbol", F.to_date("at").alias("day"), minute).agg(F.max_by("r.c", "at").alias("c"), F.sum(volume).alias("v"))
    nan = F.lit(float("nan"))
    # the imputation is heavy for its bytes, so these partitions must not be merged by size
    spread = by_minute.repartition(heavy_partitions(bars.sparkSession), "symbol", "day")
    series = spread.groupBy("symbol", "day").agg(
        F.collect_list("m").alias("minutes"), F.collect_list("c").alias("closes"), F.collect_list(F.coalesce("v", nan)).alias("volumes")
    )
    filled = series.mapInPandas(_fill, GRID)
    text = F.format_string("%s %02d:%02d", F.col("day").cast("string"), F.expr("minute_of_day div 60"), F.col("minute_of_day") % 60)
    return filled.select("symbol", text.alias("minute"), "Close", "Volume", "filled", "volume_filled", "unsettled", "volume_unsettled")
