"""Salary text to bucket, as native column expressions (no UDF, stays in whole-stage codegen).

A salary is ``"lo-hi"``. Side 0 (floor) buckets ``lo``, side 1 (ceiling) buckets ``hi``. The text
must split into exactly two parts on ``-`` (trailing empty parts dropped, as Java's split does),
and the chosen part must be a plain integer (an optional ``+`` and ASCII digits, fitting in 32
bits; a ``-`` sign cannot occur inside a part); anything else has no bucket. Buckets are half-open ``[lo, hi)`` on a uniform grid ``start, start+step, ...``
whose last bucket is clipped to ``end``; values ``>= end`` have no bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A salary has a bucket on a side only when it splits on "-" into exactly two parts (trailing
# empty parts dropped) and the part on that side is a plain integer. One anchored pattern per side
# expresses both conditions, so the value is read with a single regex per row.
SIDE_PATTERNS = {
    0: r"^([+]?[0-9]+)-[^-]+-*\z",
    1: r"^[^-]*-([+]?[0-9]+)-*\z",
}


def check_grid(start: int, end: int, step: int) -> None:
    if step <= 0:
        raise ValueError(f"salary grid step must be positive, got {step}")


def grid_frame(spark, start: int, end: int, step: int):
    """``lo, hi`` — the buckets of a grid in order (F1); the last one is clipped to ``end``."""
    check_grid(start, end, step)
    if start >= end:
        return spark.createDataFrame([], "lo int, hi int")
    lo = F.explode(F.sequence(F.lit(start), F.lit(end - 1), F.lit(step))).alias("lo")
    return spark.range(1).select(lo).select("lo", bucket_hi(F.col("lo"), end, step).alias("hi"))


def salary_part(salary: Column | str, side: int, on_bad: str = "null") -> Column:
    """The integer at ``side`` of ``"lo-hi"`` or NULL (wrong shape, not an integer, overflow).

    ``on_bad='fail'`` follows the older copy of the reference, which had no exception handler:
    a two-part salary whose part is not an integer fails the job instead of being skipped.
    """
    s = F.col(salary) if isinstance(salary, str) else salary
    value = F.regexp_extract(s, SIDE_PATTERNS[side], 1).try_cast("int")
    if on_bad == "null":
        return value
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'null' or 'fail', got {on_bad!r}")
    two_parts = F.size(F.split(F.regexp_replace(s, "-+\\z", ""), "-", -1)) == 2
    bad = two_parts & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("bad salary: "), s)).cast("int")).otherwise(value)


def bucket_lo(value: Column, start: int, end: int, step: int) -> Column:
    """Lower edge of the grid bucket holding ``value`` (NULL if outside ``[start, end)``)."""
    check_grid(start, end, step)
    v = value.cast("bigint")
    inside = (v >= F.lit(start)) & (v < F.lit(end))
    return F.when(inside, (v - (v - F.lit(start)) % F.lit(step)).cast("int"))


def bucket_hi(lo: Column, end: int, step: int) -> Column:
    """Upper edge (the last bucket is clipped to ``end``); NULL when ``lo`` is NULL."""
    return F.when(lo.isNotNull(), F.least(lo.cast("bigint") + F.lit(step), F.lit(end)).cast("int"))


def bucket_label(lo: Column, hi: Column) -> Column:
    """``"lo-hi"`` key of a bucket."""
    return F.concat(lo.cast("string"), F.lit("-"), hi.cast("string"))


def keep_bucket(lo: Column, hi: Column, drop_zero_floor: bool) -> Column:
    """Which buckets the jobs report.

    Batch jobs drop the no-bucket marker, i.e. rows whose upper edge is missing or 0. The stream
    job instead drops rows whose lower edge is missing or 0, so it also loses the first bucket of a
    grid starting at 0.
    """
    if drop_zero_floor:
        return lo.isNotNull() & (lo != 0)
    return hi.isNotNull() & (hi != 0)


def edge_bucket(value: Column, edges: Sequence[int]) -> tuple[Column, Column]:
    """``(lo, hi)`` for arbitrary sorted edges ``e0 < e1 < ... < en``: ``[e_i, e_{i+1})``.

    The edge list is a small parameter, inlined as a literal array; the lookup counts the edges at
    or below the value, so it needs no join at all.
    """
    ed = [int(e) for e in edges]
    if any(b <= a for a, b in zip(ed, ed[1:])):
        raise ValueError("edges must be strictly increasing")
    arr = F.array(*[F.lit(e) for e in ed])
    v = value.cast("bigint")
    idx = F.size(F.filter(arr, lambda e: e <= v))  # 1-based position of the lower edge
    inside = v.isNotNull() & (idx >= 1) & (idx < len(ed))
    lo = F.when(inside, F.element_at(arr, idx))
    hi = F.when(inside, F.element_at(arr, idx + 1))
    return lo.cast("int"), hi.cast("int")
