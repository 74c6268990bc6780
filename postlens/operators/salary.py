"""Salary histograms (A1-A3), bucket assignment (F2) and arbitrary-edge buckets.

Each histogram is one partial + final hash aggregate on ``(lo, hi)``: the map side emits at most
one row per bucket per task, so a hot bucket cannot overload a reducer.

The expressions are staged in separate projections (value, then lower edge, then upper edge) and
buckets the job does not report are dropped *after* the aggregate (``count_if`` + ``n > 0``).
A filter on ``lo``/``hi`` before the aggregate would be pushed down through the projections with
every alias substituted, re-evaluating the salary regex many times per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens import schema
from postlens.functions.salary import bucket_hi, bucket_label, bucket_lo, edge_bucket, grid_frame, keep_bucket, salary_part


def bucketed(postings: DataFrame, sides: Sequence[int], grid: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """``keep..., side, lo, hi`` — one row per posting and side (NULL edges = no bucket)."""
    start, end, step = grid
    if len(sides) == 1:
        vals = postings.select(*keep, F.lit(sides[0]).alias("side"), salary_part("salary", sides[0]).alias("_v"))
    else:
        pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), salary_part("salary", s).alias("_v")) for s in sides]))
        vals = postings.select(*keep, pairs.alias("_b")).select(*keep, "_b.side", "_b._v")
    los = vals.select(*keep, "side", bucket_lo(F.col("_v"), start, end, step).alias("lo"))
    return los.select(*keep, "side", "lo", bucket_hi(F.col("lo"), end, step).alias("hi"))


def count_buckets(rows: DataFrame, keys: Sequence[str], drop_zero_floor: bool) -> DataFrame:
    """``keys..., bucket, lo, hi, n`` over reported buckets only (see module note)."""
    kept = F.count_if(keep_bucket(F.col("lo"), F.col("hi"), drop_zero_floor))
    return (
        rows.groupBy(*keys, "lo", "hi")
        .agg(kept.alias("n"))
        .where(F.col("n") > 0)
        .select(*keys, bucket_label(F.col("lo"), F.col("hi")).alias("bucket"), "lo", "hi", "n")
    )


def assign_buckets(postings: DataFrame, grid: Sequence[int] = schema.STREAM_GRID) -> DataFrame:
    """Per posting: ``id, salary, floor_lo, floor_hi, ceil_lo, ceil_hi`` (NULL = no bucket)."""
    start, end, step = grid
    vals = postings.select(
        "id", "salary",
        salary_part("salary", schema.FLOOR).alias("_f"),
        salary_part("salary", schema.CEILING).alias("_c"),
    )
    los = vals.select(
        "id", "salary",
        bucket_lo(F.col("_f"), start, end, step).alias("floor_lo"),
        bucket_lo(F.col("_c"), start, end, step).alias("ceil_lo"),
    )
    return los.select(
        "id", "salary",
        "floor_lo", bucket_hi(F.col("floor_lo"), end, step).alias("floor_hi"),
        "ceil_lo", bucket_hi(F.col("ceil_lo"), end, step).alias("ceil_hi"),
    )


def histogram(
    postings: DataFrame,
    side: int = schema.CEILING,
    grid: Sequence[int] = schema.BATCH_GRID,
    drop_zero_floor: bool = False,
) -> DataFrame:
    """``bucket, lo, hi, n`` — count of postings per salary bucket of one side."""
    return count_buckets(bucketed(postings, [side], grid), [], drop_zero_floor)


def cohort(postings: DataFrame, experience: str = schema.COHORT_EXPERIENCE, education: str = schema.COHORT_EDUCATION) -> DataFrame:
    """Postings of one (experience, education) cohort; rows need the education field (>= 10)."""
    return postings.where(
        (F.col("n_fields") >= schema.GATE_DIMENSIONS)
        & (F.col("experience") == experience)
        & (F.col("education") == education)
    )


def two_sided_histogram(postings: DataFrame, grid: Sequence[int] = schema.BATCH_GRID, drop_zero_floor: bool = False) -> DataFrame:
    """``side, bucket, lo, hi, n`` for both sides in one aggregate (one scan, one shuffle)."""
    return count_buckets(bucketed(postings, [schema.FLOOR, schema.CEILING], grid), ["side"], drop_zero_floor)


def edge_histogram(postings: DataFrame, edges: Sequence[int], side: int = schema.CEILING) -> DataFrame:
    """``bucket, lo, hi, n`` over arbitrary increasing edges (the range-lookup form of J2)."""
    vals = postings.select(salary_part("salary", side).alias("_v"))
    lo, hi = edge_bucket(F.col("_v"), edges)
    rows = vals.select(lo.alias("lo"), hi.alias("hi"))
    return (
        rows.groupBy("lo", "hi")
        .agg(F.count_if(F.col("lo").isNotNull()).alias("n"))
        .where(F.col("n") > 0)
        .select(bucket_label(F.col("lo"), F.col("hi")).alias("bucket"), "lo", "hi", "n")
    )


def full_grid_histogram(postings: DataFrame, side: int = schema.CEILING, grid: Sequence[int] = schema.BATCH_GRID) -> DataFrame:
    """``bucket, lo, hi, n`` for every bucket of the grid (F1), with 0 where no posting falls."""
    counted = histogram(postings, side, grid).select("lo", "hi", "n")
    buckets = grid_frame(postings.sparkSession, *grid)
    joined = buckets.join(counted, ["lo", "hi"], "left")
    return joined.select(bucket_label(F.col("lo"), F.col("hi")).alias("bucket"), "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
