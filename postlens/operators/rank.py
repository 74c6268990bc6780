"""Row number within groups that does not funnel a whole group into one task.

``row_number().over(Window.partitionBy(g).orderBy(...))`` sorts each group ``g`` in a single
task; with few groups (five dimensions, or one global word ranking) that is one task for all the
data. Here the rows are range-partitioned on ``(g, order...)`` instead, so a large group spans many
tasks:

1. range-partition and sort within partitions (one shuffle, balanced by sampling);
2. tag each row with its partition and position (``monotonically_increasing_id`` right after the
   sort: partition id in the upper bits, position in the lower bits);
3. count rows per (partition, group) — at most one row per partition and group — and turn the
   counts into per-partition offsets with a window over that small table;
4. join the offsets back (AQE broadcasts them when small, from runtime statistics).

The order must be total (tie-broken by a unique column). The tagged rows are used twice (counts
and join), so they are written once with a reliable ``checkpoint()`` to the shared checkpoint
folder: a task recomputed after an executor loss reads the same tags instead of re-deriving
them. The input is already aggregated (distinct keys), so the checkpoint is small next to the
data that produced it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import shared_dir

_POS_BITS = 33


def row_number_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rnk") -> DataFrame:
    """``df`` plus ``name`` = 1-based row number of each row within its group, by ``order``."""
    keys = [F.col(g) for g in groups] + list(order)
    shared_dir(df.sparkSession)  # makes sure the context has its checkpoint folder
    tagged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftrightunsigned("_mid", _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("_mid")
        .checkpoint(eager=True)
    )
    per_part = tagged.groupBy("_part", *groups).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_part", *groups, "_first", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_before")
    )
    joined = tagged.join(offsets, ["_part", *groups]) if groups else tagged.join(offsets, "_part")
    rank = (F.col("_before") + F.col("_pos") - F.col("_first") + 1).alias(name)
    return joined.select(*df.columns, rank)
