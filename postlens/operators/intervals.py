"""Range join: values with the intervals that hold them, intervals from a table and free to overlap.

Every half-open interval of whole numbers is an exact union of *cells*, blocks of ``2^k`` numbers that
begin at a multiple of ``2^k``; it takes at most two of each size. A value lies in one cell of each size.
So the join is an equality on (size, cell): no nested loop, no candidate that doesn't match, no
width to tune, and neither side needs to be small. Only the sizes that some interval uses (64 at most)
are made for the values.

Values are joined once each: rows are counted per value first (with map-side aggregation), so a value of
a third of all rows is one row. A wide interval's cell may still hold many distinct values; cells are
therefore repeated in ``slices`` and values dealt to them by hash, beside what adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Open ends stand for these; values and bounds lie between them.
LEAST, MOST = -(1 << 62), 1 << 62
SLICES = 8


def cover(lo: Column, hi: Column) -> Column:
    """``ARRAY<STRUCT<size, cell>>``: the cells whose union is ``[lo, hi)``; none where ``lo >= hi``."""

    def of_size(k: Column) -> Column:
        # The interval in units of 2^k: its lower end rounded up, its upper end down. An odd end closes a cell here.
        low, high = -F.call_function("shiftright", -lo, k), F.call_function("shiftright", hi, k)
        size = k.cast("int").alias("size")
        first = F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), F.struct(size, low.alias("cell")))
        last = F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), F.struct(size, (high - 1).alias("cell")))
        return F.array(first, last)

    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(62)), of_size))
    return F.filter(cells, lambda c: c.isNotNull())


def value_intervals(values: DataFrame, intervals: DataFrame, value_col: str, lo_col: str, hi_col: str, keep: Sequence[str] = (), slices: int = SLICES) -> DataFrame:
    """``values`` (all columns, one row per value at best) with the columns ``keep`` of every interval
    ``lo <= value < hi``. A NULL value or an empty interval matches nothing; a NULL end is open."""
    lo = F.coalesce(F.col(lo_col).cast("bigint"), F.lit(LEAST))
    hi = F.coalesce(F.col(hi_col).cast("bigint"), F.lit(MOST))
    kept = F.struct(*[F.col(c) for c in keep]).alias("_interval")
    cells = intervals.select(kept, F.explode(cover(lo, hi)).alias("_c")).select("_interval", "_c.size", "_c.cell")
    sizes = sorted(r["size"] for r in cells.select("size").distinct().collect())  # 63 at most
    cells = cells.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    at = F.array(*[F.struct(F.lit(k).alias("size"), F.shiftright(F.col(value_col).cast("bigint"), k).alias("cell")) for k in sizes])
    if not sizes:
        at = F.array().cast("array<struct<size: int, cell: bigint>>")
    row = F.struct(*[F.col(c) for c in values.columns]).alias("_row")
    dealt = F.pmod(F.xxhash64(value_col), F.lit(slices)).cast("int").alias("_slice")
    points = values.where(F.col(value_col).isNotNull()).select(row, dealt, F.explode(at).alias("_c")).select("_row", "_slice", "_c.size", "_c.cell")
    joined = points.join(cells, ["size", "cell", "_slice"])
    return joined.select("_row.*", *[F.col("_interval")[c].alias(c) for c in keep])


def interval_counts(rows: DataFrame, intervals: DataFrame, value_col: str, key_cols: Sequence[str], lo_col: str = "lo", hi_col: str = "hi") -> DataFrame:
    """``key_cols..., lo, hi, n`` — how many rows have a value in each interval (intervals without any are left out)."""
    counted = rows.groupBy(F.col(value_col).cast("bigint").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    keep = [*key_cols, lo_col, hi_col]
    return value_intervals(counted, intervals, "_value", lo_col, hi_col, keep).groupBy(*keep).agg(F.sum("_n").alias("n"))
