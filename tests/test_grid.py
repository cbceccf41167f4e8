import datetime as dt

import numpy as np
import pandas as pd

from quaymark.operators import grid

SCHEMA = "bar_id long, symbol string, Date timestamp_ntz, Close float, Volume float, folder_date date, filled int"
DAY = dt.date(2024, 3, 1)


def bar(i, minute, close, volume=100.0, symbol="A", second=0, folder=DAY):
    return (i, symbol, dt.datetime(2024, 3, 1, 9, 30) + dt.timedelta(minutes=minute, seconds=second), close, volume, folder, 1)


def run(spark, rows):
    return {(r.symbol, r.minute[11:]): r for r in grid.minute_grid(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_gaps_are_filled_and_marked(spark):
    rows = [bar(0, 0, 10.0), bar(1, 1, None), bar(2, 2, float("nan")), bar(3, 3, 13.0), bar(4, 5, 15.0, None), bar(5, 9, None)]
    got = run(spark, rows)
    assert sorted(m for _, m in got) == ["09:30", "09:31", "09:32", "09:33", "09:34", "09:35"]
    assert [m for (_, m), r in sorted(got.items()) if r.filled] == ["09:31", "09:32", "09:34"]
    assert got["A", "09:31"].Close == 11.0 and got["A", "09:34"].Close == 14.0
    assert not got["A", "09:35"].filled and got["A", "09:35"].volume_filled and got["A", "09:35"].Volume == 100.0


def test_uneven_clocks_ties_and_late_deliveries(spark):
    late = dt.date(2024, 3, 4)
    rows = [bar(0, 0, 10.0, 5.0, second=7), bar(1, 0, 11.0, 6.0, second=52), bar(2, 0, 12.0, 7.0, second=52, folder=late), bar(3, 0, 12.0, 7.0, second=52, folder=late), bar(4, 1, 20.0)]
    got = run(spark, rows)
    assert got["A", "09:30"].Close == 12.0 and got["A", "09:30"].Volume == 12.0


def test_days_and_symbols_stand_alone_and_nothing_comes_of_nothing(spark):
    rows = [bar(0, 0, 1.0), (1, "A", dt.datetime(2024, 3, 2, 9, 32), 2.0, 1.0, DAY, 1), bar(2, 1, 1.0, symbol="B"), (3, None, dt.datetime(2024, 3, 2), 1.0, 1.0, DAY, 1), (4, "C", None, 1.0, 1.0, DAY, 1), bar(5, 0, None, symbol="D")]
    assert len(run(spark, rows)) == 3
    assert run(spark, rows[:0]) == {}
    one = run(spark, [bar(0, 0, 1.0, None)])["A", "09:30"]
    assert one.Close == 1.0 and one.volume_filled and one.Volume is None


def test_imputation_of_a_periodic_series_beats_interpolation():
    t = np.arange(200)
    x = 10 + np.sin(2 * np.pi * t / 12) + 0.3 * np.sin(2 * np.pi * t / 5)
    missing = np.zeros(200, dtype=bool)
    missing[[20, 21, 22, 23, 24, 25, 80, 81, 82, 83, 120, 121, 150]] = True
    got = grid.impute(x, missing)
    straight = np.interp(t[missing], t[~missing], x[~missing])
    assert np.abs(got[missing] - x[missing]).mean() < 0.25 * np.abs(straight - x[missing]).mean()
    assert (got[~missing] == x[~missing]).all()


def test_imputation_edges():
    none, every = np.zeros(4, bool), np.ones(4, bool)
    assert (grid.impute(np.arange(4.0), none) == np.arange(4)).all()
    assert np.isnan(grid.impute(np.arange(4.0), every)).all()
    constant = grid.impute(np.array([5.0] * 20), np.arange(20) % 3 == 1)
    assert (constant == 5.0).all()


def _slow_series():
    rng = np.random.default_rng(1)
    x = rng.normal(size=90) + 10
    missing = rng.random(90) < 0.4
    missing[[0, -1]] = False
    return x, missing


def test_imputation_goes_on_until_it_settles():
    x, missing = _slow_series()
    far = grid.impute(x, missing, rounds=200_000)
    assert np.abs(grid.impute(x, missing) - far).max() <= 1e-9 * x.std()
    assert np.abs(grid.impute(x, missing, rounds=40) - far).max() > 0.5 * x[~missing].std()
    assert grid.settle(x, missing)[1] and not grid.settle(x, missing, rounds=40)[1]


def test_minutes_of_a_series_that_does_not_settle_are_marked(monkeypatch):
    x, missing = _slow_series()
    full = grid.settle
    monkeypatch.setattr(grid, "settle", lambda v, m: full(v, m, rounds=40))
    at = np.flatnonzero(~missing)
    batch = pd.DataFrame({"symbol": ["A"], "day": [DAY], "minutes": [at], "closes": [x[at]], "volumes": [np.full(len(at), 5.0)]})
    (got,) = grid._fill([batch])
    assert (got.unsettled == missing).all() and not got.volume_unsettled.any()


def plainly(values, missing, window=60, rank=6, energy=0.95, tolerance=1e-7):
    """The method word by word: Hankel matrix, leading singular vectors, mean of the antidiagonals, again until nothing moves."""
    out, at = values.copy(), np.arange(len(values))
    out[missing] = np.interp(at[missing], at[~missing], values[~missing])
    n, mean, keep = len(out), None, None
    rows = max(2, min(window, n // 3))
    mean = out.mean()
    for _ in range(50_000):
        h = np.array([[out[i + j] - mean for j in range(n - rows + 1)] for i in range(rows)])
        u, power, v = np.linalg.svd(h, full_matrices=False)
        if keep is None:
            keep = min(rank, int(np.searchsorted(np.cumsum(power**2) / (power**2).sum(), energy)) + 1)
        r = (u[:, :keep] * power[:keep]) @ v[:keep]
        fresh = np.array([np.mean(np.fliplr(r).diagonal(n - rows - i)) for i in range(n)]) + mean
        moved = np.abs(fresh - out)[missing].max()
        out[missing] = fresh[missing]
        if moved <= tolerance * values[~missing].std():
            break
    return out


def test_filled_values_are_those_of_the_plain_repetition():
    rng = np.random.default_rng(1)
    for seed in range(3):
        t = np.arange(90)
        x = 50 + 3 * np.sin(2 * np.pi * t / (9 + seed)) + 0.1 * rng.normal(size=90)
        missing = np.zeros(90, bool)
        missing[rng.choice(np.arange(5, 85), 12, replace=False)] = True
        got, settled = grid.settle(np.where(missing, 0.0, x), missing, window=20)
        want = plainly(np.where(missing, 0.0, x), missing, window=20)
        # within the tolerance of an entry that no longer moves, over what the repetitions left could still add
        assert settled and np.abs(got - want)[missing].max() < 0.01 * x[~missing].std()
