"""Range join against brute force: overlapping, open, empty and extreme intervals; plan without a nested loop."""

import random

from pyspark.sql import functions as F

from postlens.operators import intervals
from tests.conftest import plan_text


def frames(spark, values, ranges):
    return (
        spark.createDataFrame([(v,) for v in values], "v long"),
        spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(ranges)], "id int, lo long, hi long"),
    )


def brute(values, ranges):
    out = {}
    for i, (lo, hi) in enumerate(ranges):
        n = sum(v is not None and (lo is None or lo <= v) and (hi is None or v < hi) for v in values)
        if n:
            out[i] = n
    return out


def check(spark, values, ranges):
    rows, table = frames(spark, values, ranges)
    got = {r["id"]: r["n"] for r in intervals.interval_counts(rows, table, "v", ["id"]).collect()}
    assert got == brute(values, ranges)


def test_random_ranges_against_brute_force(spark):
    rng = random.Random(1)
    for width in (3, 50, 10**6, 10**15):
        point = lambda: rng.randrange(-width, width)
        ranges = [(rng.choice((point(), None)) if rng.random() < 0.2 else point(), rng.choice((point(), None)) if rng.random() < 0.2 else point()) for _ in range(60)]
        check(spark, [point() for _ in range(150)] + [None, 0, 0, 0], ranges)


def test_extreme_and_empty_ranges(spark):
    big = 1 << 61
    check(spark, [-big, big, 0, -1, 1, None], [(None, None), (-big, big), (0, 0), (5, 1), (-1, 1), (0, 1), (big, None), (None, -big)])
    check(spark, [1, 2], [])
    check(spark, [], [(0, 5)])


def test_cover_is_exact_and_small(spark):
    rng = random.Random(2)
    pairs = [(a, a + rng.randrange(0, 3000)) for a in (rng.randrange(-2000, 2000) for _ in range(200))]
    df = spark.createDataFrame(pairs, "lo long, hi long")
    for r in df.select("lo", "hi", intervals.cover(F.col("lo"), F.col("hi")).alias("c")).collect():
        held = [v for size, cell in r["c"] for v in range(cell << size, (cell + 1) << size)]
        assert sorted(held) == list(range(r["lo"], r["hi"])) and len(r["c"]) <= 24


def test_plan_is_an_equality_join(spark):
    rows, table = frames(spark, range(50), [(1, 9), (3, 30)])
    plan = plan_text(intervals.interval_counts(rows, table, "v", ["id"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_rows_keep_their_columns(spark):
    rows, table = frames(spark, [4, 7], [(0, 5), (4, 8)])
    got = intervals.value_intervals(rows.withColumn("x", F.col("v") * 2), table, "v", "lo", "hi", ["id"])
    assert got.columns == ["v", "x", "id"] and sorted(map(tuple, got.collect())) == [(4, 8, 0), (4, 8, 1), (7, 14, 1)]
