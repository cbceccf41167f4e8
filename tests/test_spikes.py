import datetime as dt

import numpy as np
import pytest

from quaymark.operators import spikes

DAILY = "bar_id long, symbol string, Date date, Close float, Volume float, SplitCoefficient float, folder_date date"
MINUTE = "bar_id long, symbol string, Date timestamp_ntz, High float, Low float, folder_date date"
D0 = dt.date(2024, 1, 1)


def noise(n, scale=0.01, seed=3):
    return np.random.default_rng(seed).normal(0, scale, n)


def walk(n=200, seed=3):
    return np.cumsum(noise(n, 0.01, seed)) + 4


def test_spikes_of_up_to_three_rows_and_not_moves_that_last():
    x = walk()
    x[50] += 1
    x[100:103] -= 0.8
    x[150:] += 0.7
    assert list(np.flatnonzero(spikes.phase_space_spikes(x))) == [50, 100, 101, 102]


def test_longer_excursions_and_heavy_tails_are_no_spikes():
    x = walk()
    x[60:65] += 1
    assert not spikes.phase_space_spikes(x).any()
    t = np.cumsum(np.random.default_rng(4).standard_t(4, 400) * 0.01)
    assert not spikes.phase_space_spikes(t).any()


def test_short_and_constant_series():
    assert not spikes.phase_space_spikes(np.array([1.0, 9.0, 1.0])).any()
    flat = np.full(60, 2.0)
    flat[30] = 5
    assert list(np.flatnonzero(spikes.phase_space_spikes(flat))) == [30]
    assert not spikes.phase_space_spikes(np.full(60, 2.0)).any()


def test_stuck_runs_against_the_usual():
    lively = np.random.default_rng(1).normal(size=100)
    lively[40:47] = lively[40]
    assert list(np.flatnonzero(spikes.stuck_runs(lively))) == list(range(41, 47))
    quiet = np.repeat(np.random.default_rng(2).normal(size=60), np.random.default_rng(5).choice([1, 1, 2, 3, 4], 60))
    assert not spikes.stuck_runs(quiet).any()
    assert not spikes.stuck_runs(lively[:3]).any()


def test_splits_that_close_follows_or_not():
    close = walk()
    coefficient = np.ones(200)
    close[80:] -= np.log(3)
    coefficient[[80, 120]] = 3, 2
    assert list(np.flatnonzero(spikes.false_splits(close, coefficient, np.zeros(200, bool)))) == [120]


def test_operator(spark):
    price, volume = np.exp(walk()), np.exp(noise(200, 0.3, 7) + 10)
    rows = [[i, "A", D0 + dt.timedelta(days=i), float(price[i]), float(volume[i]), 1.0, D0] for i in range(200)]
    rows[50][3] *= 100
    rows[70][3] = -1.0
    rows[90][4] = -5.0
    rows[100][5] = 2.0
    rows[110][5] = 0.0
    rows[120][3], rows[121][3] = None, float("nan")
    again = [1000, *rows[50][1:6], D0 + dt.timedelta(days=9)]
    loose = [[2000, None, D0, 0.0, 1.0, 1.0, D0], [2001, "B", None, 5.0, 1.0, -1.0, D0], [2002, "B", D0, 5.0, 1.0, 1.0, D0]]
    minutes = [[i, "A", dt.datetime(2024, 1, 1, 9, 30) + dt.timedelta(minutes=i), float(10 + noise(60)[i]), 9.0, D0] for i in range(60)]
    minutes[20][3] = 14.0
    minutes[40][3] = 8.5
    got = spikes.implausible_readings(spark.createDataFrame([tuple(r) for r in [*rows, again, *loose]], DAILY), spark.createDataFrame([tuple(r) for r in minutes], MINUTE))
    assert sorted(map(tuple, got.collect())) == sorted([
        ("prices_daily", 50, "Close"), ("prices_daily", 70, "Close"), ("prices_daily", 90, "Volume"), ("prices_daily", 100, "SplitCoefficient"),
        ("prices_daily", 110, "SplitCoefficient"), ("prices_daily", 2000, "Close"), ("prices_daily", 2001, "SplitCoefficient"), ("prices", 20, "High"), ("prices", 40, "High"),
    ])


def test_blocks_agree_with_their_neighbours_and_empty_tables(spark):
    n = 2500
    x = np.exp(np.cumsum(noise(n, 0.01, 8)) * 0.2 + 4)
    rows = [(i, "A", D0 + dt.timedelta(days=i), float(x[i]), 100.0 + i, 1.0, D0) for i in range(n)]
    spiked = {700, 1023, 1024, 1800, 2040}
    rows = [(*r[:3], r[3] * 5 if r[0] in spiked else r[3], *r[4:]) for r in rows]
    empty = spark.createDataFrame([], MINUTE)
    got = spikes.implausible_readings(spark.createDataFrame(rows, DAILY), empty).collect()
    assert {r.bar_id for r in got} == spiked and len(got) == len(spiked)
    assert spikes.implausible_readings(spark.createDataFrame([], DAILY), empty).count() == 0


def _minutes(day, logs, first_id):
    start = dt.datetime.combine(D0 + dt.timedelta(days=day), dt.time(9, 30))
    return [(first_id + i, "A", start + dt.timedelta(minutes=i), float(np.exp(v)), 1.0, D0 + dt.timedelta(days=day)) for i, v in enumerate(logs)]


def test_minutes_are_judged_by_the_symbol_and_not_by_the_day(spark):
    # days far apart; spikes at the last and at the first minute of a day, between one and two thresholds, and on a day of five readings
    logs = [4 + noise(120, seed=s) for s in (1, 2, 3)] + [4 + noise(5, seed=4)]
    logs[0][-1] += 0.15
    logs[2][0] += 0.15
    logs[3][2] += 0.5
    rows = [r for k, v in enumerate(logs) for r in _minutes(60 * k, v, 1000 * k)]
    got = spikes.implausible_readings(spark.createDataFrame([], DAILY), spark.createDataFrame(rows, MINUTE)).collect()
    assert {(r.bar_id, r.field) for r in got} == {(119, "High"), (2000, "High"), (3002, "High")}


def test_minutes_of_many_short_days_are_found_once(spark):
    # more days than a block holds, each too short to be judged alone; 33 leaves one day to the last block
    logs = [4 + noise(3, seed=s) for s in range(33)]
    for k in (0, 15, 16, 31, 32):
        logs[k][1] += 0.6
    rows = [r for k, v in enumerate(logs) for r in _minutes(3 * k, v, 10 * k)]
    got = spikes.implausible_readings(spark.createDataFrame([], DAILY), spark.createDataFrame(rows, MINUTE)).collect()
    assert sorted(r.bar_id for r in got) == [1, 151, 161, 311, 321]


def test_the_search_goes_on_while_anything_new_is_found(monkeypatch):
    # a level that shows one more spike at each round
    x = 4 + noise(400)
    at = list(range(20, 320, 20))
    x[at] += 1
    calls = []

    def level(clean):
        calls.append(1)
        hidden = np.full(len(x), 4.0)
        hidden[at[len(calls) :]] = x[at[len(calls) :]]
        return hidden

    monkeypatch.setattr(spikes, "local_level", level)
    assert list(np.flatnonzero(spikes.phase_space_spikes(x))) == at and len(calls) == len(at) + 1


def correlated(n=4000, seed=2, rho=0.9):
    """Distances from a level that move slowly: their differences are small beside them."""
    rng = np.random.default_rng(seed)
    u, e = np.zeros(n), rng.normal(size=n) * np.sqrt(1 - rho**2)
    for i in range(1, n):
        u[i] = rho * u[i - 1] + e[i]
    return u


@pytest.mark.parametrize(("which", "shape", "rho"), [(0, (1.0, 1.0), 0.0), (1, (1.0, 1.0), 0.9), (2, (1.0,), 0.5)])
def test_each_ellipse_decides_alone_somewhere(which, shape, rho):
    # a jump of the given shape and of rising size: some size is outside this ellipse and inside the two others and the value's own limit
    base = correlated(rho=rho)
    limit, at, alone = 12.0, 2000, []
    base[at - 4 : at + 6] = 0.0
    for size in np.arange(2.0, 12.0, 0.1):
        u = base.copy()
        u[at : at + len(shape)] += size * np.array(shape)
        masks = spikes.outside_ellipses(u, np.ones(len(u), bool), limit, 0.01)
        if masks[which][at] and not any(m[at] for k, m in enumerate(masks) if k != which):
            alone.append(size)
    assert alone and max(alone) < limit * base.std()


def test_the_differences_tell_a_spike_that_its_value_does_not():
    # two rows within the value's own limit: only the ellipse of value and first difference shows them
    x = np.random.default_rng(4).normal(size=3000)
    x[1996:2006] = 0.0
    limit = spikes.FACTOR * np.sqrt(2 * np.log(len(x)))
    x[2000:2002] = 0.96 * limit
    assert np.flatnonzero(spikes.phase_space_spikes(x)).tolist() == [2000, 2001]


def test_without_the_ellipses_of_the_differences_it_is_not_found(monkeypatch):
    x = np.random.default_rng(4).normal(size=3000)
    x[1996:2006] = 0.0
    x[2000:2002] = 0.96 * spikes.FACTOR * np.sqrt(2 * np.log(len(x)))
    by_value = lambda u, kept, limit, least: (np.abs(u) > limit * max(spikes._scale(u[kept]), least),)
    monkeypatch.setattr(spikes, "outside_ellipses", by_value)
    assert not spikes.phase_space_spikes(x).any()
