"""Salary micro-fixture (FIXTURES 3), grids and bucket properties."""

import random

import pytest
from pyspark.sql import functions as F

from postlens.functions.salary import bucket_hi, bucket_lo, edge_bucket, grid_frame, salary_part
from postlens.operators import salary as ops

GRID = (0, 40000, 3000)

CASES = [
    # salary, floor bucket, ceiling bucket
    ("5000-8000", (3000, 6000), (6000, 9000)),
    ("5000-8000元/月", (3000, 6000), None),
    ("-5000", None, (3000, 6000)),
    ("5000-", None, None),
    ("1-2-3", None, None),
    ("面议", None, None),
    ("1000元以下", None, None),
    ("", None, None),
    ("-", None, None),
    (" 5000-6000", None, (6000, 9000)),
    ("5000.5-6000", None, (6000, 9000)),
    ("+5-+7", (0, 3000), (0, 3000)),
    ("99999999999-5", None, (0, 3000)),
    ("3000-3000", (3000, 6000), (3000, 6000)),
    ("39999-40000", (39000, 40000), None),
    ("５０００-６０００", None, None),
    ("--5", None, None),
    ("5000-8000--", (3000, 6000), (6000, 9000)),
    (None, None, None),
]


def grid_buckets(start, end, step):
    """The buckets of a grid, by counting up."""
    return [(lo, min(lo + step, end)) for lo in range(start, end, step)]


def salary_bucket(name, side, grid):
    lo = bucket_lo(salary_part(name, side), *grid)
    return lo, bucket_hi(lo, grid[1], grid[2])


def test_bucket_micro_fixture(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in CASES], "salary string")
    flo, fhi = salary_bucket("salary", 0, GRID)
    clo, chi = salary_bucket("salary", 1, GRID)
    rows = df.select("salary", flo.alias("flo"), fhi.alias("fhi"), clo.alias("clo"), chi.alias("chi")).collect()
    got = {r["salary"]: (r["flo"], r["fhi"], r["clo"], r["chi"]) for r in rows}
    for s, f, c in CASES:
        exp = (f or (None, None)) + (c or (None, None))
        assert got[s] == exp, s


def test_grids(spark):
    for grid in [(0, 40000, 3000), (0, 40000, 5000), (-3000, 10, 7), (5, 5, 1), (20, 10, 5)]:
        assert sorted((r["lo"], r["hi"]) for r in grid_frame(spark, *grid).collect()) == grid_buckets(*grid)
    assert grid_buckets(0, 40000, 3000)[-1] == (39000, 40000)
    with pytest.raises(ValueError):
        grid_frame(spark, 0, 10, 0)


def test_full_grid_histogram_has_empty_buckets(spark):
    df = spark.createDataFrame([("1-2",), ("9-12",), ("x",)], "salary string")
    got = [(r["bucket"], r["n"]) for r in ops.full_grid_histogram(df, 1, (0, 25, 10)).orderBy("lo").collect()]
    assert got == [("0-10", 1), ("10-20", 1), ("20-25", 0)]


def test_stream_rule_drops_first_bucket(spark):
    df = spark.createDataFrame([("100-200",), ("5000-6000",), ("bad",)], "salary string")
    df = df.withColumn("n_fields", F.lit(11))
    batch = {r["bucket"]: r["n"] for r in ops.histogram(df, 0, GRID, drop_zero_floor=False).collect()}
    stream = {r["bucket"]: r["n"] for r in ops.histogram(df, 0, GRID, drop_zero_floor=True).collect()}
    assert batch == {"0-3000": 1, "3000-6000": 1}
    assert stream == {"3000-6000": 1}


def java_split(s: str, sep: str) -> list[str]:
    parts = s.split(sep)
    while parts and parts[-1] == "" and len(parts) > 1:
        parts.pop()
    if parts == [""] and s != "":
        return []
    return parts


def parse_int(s: str):
    import re

    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return None
    v = int(s)
    return v if -(2**31) <= v < 2**31 else None


def model_bucket(s, side, grid):
    """Brute-force model of the reference rule: two parts, integer part, linear grid scan."""
    start, end, step = grid
    if s is None:
        return None
    parts = java_split(s, "-")
    if len(parts) != 2:
        return None
    v = parse_int(parts[side])
    if v is None:
        return None
    for lo in range(start, end, step):
        hi = min(lo + step, end)
        if lo <= v < hi:
            return (lo, hi)
    return None


def test_bucket_equals_brute_force_model(spark):
    rnd = random.Random(7)
    atoms = ["", "-", "--", "+", "5", "120", "3000", "39999", "40000", "99999999999", "x", " ", "元", "7.5"]
    vals = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 5))) for _ in range(1500)]
    grid = (0, 40000, 3000)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, salary string")
    cols = []
    for side in (0, 1):
        lo, hi = salary_bucket("salary", side, grid)
        cols += [lo.alias(f"lo{side}"), hi.alias(f"hi{side}")]
    for r in df.select("i", "salary", *cols).collect():
        for side in (0, 1):
            got = (r[f"lo{side}"], r[f"hi{side}"])
            want = model_bucket(r["salary"], side, grid) or (None, None)
            assert got == want, (r["salary"], side)


def test_histogram_total_and_tiling(spark):
    rnd = random.Random(5)
    vals = [f"{rnd.randint(0, 45000)}-{rnd.randint(0, 50000)}" for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "salary string")
    grid = (0, 40000, 5000)
    hist = ops.histogram(df, 1, grid).collect()
    assert sum(r["n"] for r in hist) == sum(1 for v in vals if int(v.split("-")[1]) < 40000)
    buckets = grid_buckets(*grid)
    for r in hist:
        assert (r["lo"], r["hi"]) in buckets


def test_arithmetic_bucket_equals_edge_bucket(spark):
    rnd = random.Random(11)
    grid = (-3000, 40000, 3000)
    edges = [lo for lo, _ in grid_buckets(*grid)] + [grid[1]]
    df = spark.createDataFrame([(rnd.randint(-10000, 50000),) for _ in range(500)], "v int")
    lo = bucket_lo(F.col("v"), *grid)
    elo, ehi = edge_bucket(F.col("v"), edges)
    rows = df.select(lo.alias("lo"), elo.alias("elo"), ehi.alias("ehi")).select(
        "lo", bucket_hi(F.col("lo"), grid[1], grid[2]).alias("hi"), "elo", "ehi"
    ).collect()
    for r in rows:
        assert (r["lo"], r["hi"]) == (r["elo"], r["ehi"])


def test_edges_must_increase():
    with pytest.raises(ValueError):
        edge_bucket(F.col("v"), [0, 10, 10])


def test_strict_mode_fails_on_bad_number(spark):
    ok = spark.createDataFrame([("5000-8000",), ("面议",), ("5000-",)], "salary string")
    assert [r[0] for r in ok.select(salary_part("salary", 1, on_bad="fail")).collect()] == [8000, None, None]
    bad = spark.createDataFrame([("5000-8000元/月",)], "salary string")
    with pytest.raises(Exception):
        bad.select(salary_part("salary", 1, on_bad="fail")).collect()
