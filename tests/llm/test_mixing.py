import hashlib
import math

from quaymark.llm import mixing

SIZES, TARGETS = "id long, source string, tokens long", "source string, target_share double, max_repeats int"


def brute(sizes, targets, seed):
    have = {}
    for _, s, t in sizes:
        have[s] = have.get(s, 0) + t
    use = {s: (w, c) for s, w, c in targets if have.get(s)}
    whole = sum(w for w, _ in use.values())
    total = min(c * have[s] * whole / w for s, (w, c) in use.items())
    out = {}
    for i, s, t in sizes:
        if s in use:
            rate = min(use[s][1], use[s][0] / whole * total / have[s])
            u = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:12], 16) / 16**12
            copies = math.floor(rate) + (u < rate - math.floor(rate))
            if copies:
                out[i] = copies
    return out


def test_mixture_against_brute_force(spark):
    sizes = [(i, "ab"[i % 3 == 0], 5 + i % 17) for i in range(600)] + [(600 + i, "c", 10) for i in range(20)] + [(700, None, 3), (701, "z", 0), (702, "other", 9)]
    targets = [("a", 0.5, 1), ("b", 0.2, 3), ("c", 0.2, 4), ("z", 0.05, 2), ("absent", 0.05, 9)]
    df, want = spark.createDataFrame(sizes, SIZES), spark.createDataFrame(targets, TARGETS)
    rate = mixing.rates(df, want)
    mix = mixing.mixture(df, rate, seed=9)
    assert {r.id: r.copies for r in mix.collect()} == brute(sizes, targets, 9)
    caps = {s: c for s, _, c in targets}
    shares = {r.source: r for r in mixing.shares(mix, rate).collect()}
    assert set(shares) == {"a", "b", "c", "z", "absent"}
    for s, r in shares.items():
        assert r.most_repeats <= caps[s] and abs(r.actual_share - r.scaled_share) < 0.05
    for s in ("z", "absent"):
        assert shares[s].rate == shares[s].tokens_out == shares[s].scaled_share == 0 and shares[s].target_share == 0.05
    assert abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    assert mixing.emitted(mix).count() == sum(brute(sizes, targets, 9).values())


def test_smaller_total_and_repeated_targets(spark):
    df = spark.createDataFrame([(i, "a", 10) for i in range(100)], SIZES)
    rate = mixing.rates(df, spark.createDataFrame([(" A ", 0.5, 2), ("a", 0.9, 2), (None, 0.1, 1), ("b", 0.1, 0)], TARGETS), total=100)
    assert [(r.source, round(r.rate, 6)) for r in rate.collect()] == [("a", 0.1)]


def test_empty_tables(spark):
    sizes, targets = spark.createDataFrame([(1, "a", 5)], SIZES), spark.createDataFrame([("a", 1.0, 2)], TARGETS)
    for s, t, reported in ((sizes.limit(0), targets, 1), (sizes, targets.limit(0), 0)):
        rate = mixing.rates(s, t)
        assert mixing.mixture(s, rate).count() == 0 and mixing.shares(mixing.mixture(s, rate), rate).count() == reported


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("wire_desk", " Wire-Desk ", "WIRE DESK", "", None)], "s string")
    assert [r[0] for r in df.select(mixing.source_label("s")).collect()] == ["wire_desk"] * 3 + [None] * 2
