"""Joins in time and frames by value against comparison of all pairs, odd rows, and what the plans hold."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fennmark.operators import temporal, usage

DAY0 = datetime(2024, 3, 1)


def at(hours):
    return None if hours is None else DAY0 + timedelta(hours=hours)


def frame(spark, rows, names="e long, k string, ts timestamp_ntz, x double"):
    return spark.createDataFrame(rows, names)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_as_of_equals_brute_force(spark):
    rng = random.Random(4)
    some = lambda n, first: [(first + k, rng.choice(["a", "b", "c", None]), at(rng.choice([None, *[h / 2 for h in range(0, 300)]])), float(k)) for k in range(n)]
    left, right = some(120, 0) + [(0, "a", at(5), 1.0)] * 2, some(80, 1000) + [(2000, "a", at(7), 1.0), (2001, "a", at(7), 2.0)]
    for strictly in (False, True):
        got = temporal.as_of_join(frame(spark, left), frame(spark, right), "k", "ts", "e", ["e", "x"], bucket_seconds=6 * 3600, strictly=strictly)
        assert got.columns == ["e", "k", "ts", "x", "last_ts", "last_e", "last_x"]
        expected = []
        for r in left:
            before = [s for s in right if r[1] is not None and s[1] == r[1] and None not in (r[2], s[2]) and (s[2] < r[2] or s[2] == r[2] and not strictly)]
            best = max(before, key=lambda s: (s[2], s[0]), default=(None, None, None, None))
            expected.append((*r, best[2], best[0], best[3]))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_as_of_splits_a_hot_key_and_compares_no_pairs(spark):
    left = frame(spark, [(k, "a", at(k / 10), 0.0) for k in range(3000)])
    right = frame(spark, [(k, "a", at(k / 5), float(k)) for k in range(1, 1000)])
    got = temporal.as_of_join(left, right, "k", "ts", "e", ["x"], bucket_seconds=3600)
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    assert all(r.last_x == (min(999.0, r.e // 2) or None) for r in got.collect())
    assert temporal.as_of_join(left.limit(0), right, "k", "ts", "e", ["x"]).count() == 0
    assert temporal.as_of_join(left, right.limit(0), "k", "ts", "e", ["x"]).filter("last_ts is null").count() == 3000


def test_intervals_equal_brute_force(spark):
    rng = random.Random(9)
    points = [(k, "p", at(rng.choice([None, *range(0, 60)])), 0.0) for k in range(60)]
    spans = [(k, at(a), at(None if a is None else a + rng.choice([-1, 0, 0.5, 3, 40]))) for k in range(40) for a in [rng.choice([None, *range(0, 50)])]]
    sides = frame(spark, points), spark.createDataFrame(spans, "s long, a timestamp_ntz, b timestamp_ntz")
    expected = sorted((p[0], s[0]) for p in points for s in spans if None not in (p[2], s[1], s[2]) and s[1] <= p[2] <= s[2])
    for seconds in (900, 3600, 100_000):
        got = temporal.interval_join(*sides, "ts", "a", "b", bin_seconds=seconds)
        assert sorted((r.e, r.s) for r in got.collect()) == expected
        assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    odd = temporal.interval_join(*sides, "ts", "a", "b", on=F.col("e") > F.col("s"))
    assert sorted((r.e, r.s) for r in odd.collect()) == [x for x in expected if x[0] > x[1]]


def test_trailing_frames_with_ties_and_gaps(spark):
    rows = [(1, "a", at(0), 1.0), (2, "a", at(0), 2.0), (3, "a", at(2), 4.0), (4, "a", at(2.0001), 8.0), (5, "a", at(9), 16.0), (6, "b", at(0), 32.0), (7, None, at(0), 64.0), (8, None, at(0), 1.0), (9, "a", at(11), None)]
    expected = {1: (2, 3.0), 2: (2, 3.0), 3: (3, 7.0), 4: (2, 12.0), 5: (1, 16.0), 6: (1, 32.0), 7: (2, 65.0), 8: (2, 65.0), 9: (2, 16.0)}
    plain = temporal.trailing(frame(spark, rows), "k", "ts", 7200, n=F.count("*"), total=F.sum("x"))
    assert {r.e: (r.n, r.total) for r in plain.collect()} == expected
    split = temporal.trailing_counts(frame(spark, rows), "k", "ts", 7200, "x", "e")
    assert {r.e: (r.n, r.total) for r in split.collect()} == expected
    assert temporal.trailing_counts(frame(spark, []), "k", "ts", 7200, "x", "e").count() == 0


def test_trailing_counts_at_random(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice("ab"), at(rng.randrange(0, 4000) / 60), 1.0) for k in range(800)]
    split = {r.e: r.n for r in temporal.trailing_counts(frame(spark, rows), "k", "ts", 3600, "x", "e").collect()}
    assert split == {r[0]: sum(s[1] == r[1] and timedelta(0) <= r[2] - s[2] <= timedelta(hours=1) for s in rows) for r in rows}


def test_sketches_merge(spark):
    rows = [(k, f"t{k % 3}", at(24 * (k % 14)), float(k % 900)) for k in range(6000)] + [(1, None, at(0), None), (2, "t9", at(0), None)]
    days = usage.distinct_sketches(frame(spark, rows).withColumn("x", F.col("x").cast("long")), F.to_date("ts"), "k", of="x")
    found = {(str(r.by), r.k): r.estimate for r in usage.merged_distinct(days, F.trunc("by", "month"), "k").collect()}
    exact = {t: len({r[3] for r in rows if r[1] == t}) for t in ("t0", "t1", "t2")}
    assert all(abs(found["2024-03-01", t] - n) <= 0.05 * n for t, n in exact.items())
    assert found["2024-03-01", "t9"] == 0 and found["2024-03-01", None] == 0
