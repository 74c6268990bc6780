"""Frequent pairs of members: every pair that at least ``support`` lists hold, with its number of lists.

Input is an inverted index ``(member, owner)``. The reference emits every pair inside every list; here
three exact steps keep pairs that can't reach the support from being made, or made twice:

1. a member of fewer than ``support`` lists has no frequent pair and leaves its lists;
2. the ``support // 2`` longest lists, of those beyond ``block`` members, are set aside: a frequent pair
   is still in ``need = support - support // 2`` of the others (in all ``support`` of them, less those set
   aside), so these hot lists never have their pairs made. They are only asked about the candidates,
   by two equality joins on the members;
3. the pairs of the other lists are first counted by a hash of the pair, in ``buckets`` buckets. Only pairs
   of buckets that reach the need are counted themselves, and are the candidates if they reach it too.

The first count aggregates within the tasks before it shuffles no more than ``buckets`` rows a task; it is left out
if there are so many pairs that the mean bucket reaches the need twice over. The second shuffles no pairs: where
most pairs are in few lists, each would be a row. Members are numbered and dealt into ``groups``; the lists are cut
by group, in slices of whole lists, and each two groups meet in a cell, a task of its own, that gets what all lists
hold of the two and so counts all occurrences of its pairs itself, by numpy. A listing is sent to ``groups`` cells,
at two to five bytes each, and there are as many groups as keep a cell at about ``CELL`` pairs: what is shuffled
grows with the listings times the root of the pairs, a task's memory doesn't. Cells are counted in rounds of a few
for each core, and each step's shuffle files go when it is written, so the disk holds one round at a time. The pairs
of a long list are spread over all cells.

Members are numbered first (the numbers written, so that a repeated task reads the same ones). The kept buckets are
broadcast: at most ``buckets`` numbers of 8 bytes, whatever the input. Choose ``buckets`` well above the pair
occurrences divided by the support, or the buckets keep everything (the answer stays right).

Results for odd input: NULL members or owners and repeated rows of the index are ignored; a support below
1 counts as 1; an empty index gives no pair.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.session import context, written

# Tasks get these functions with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 256
BUCKETS = 1 << 20
#: Pairs that a task makes at once (some 150 MB).
CHUNK = 1 << 22
#: Pairs of a cell (4 bytes each, or 8 with many members); beyond FOLD of them, those made so far are counted.
CELL, FOLD = 1 << 24, 1 << 25
#: Listings of a slice, and of a task that cuts slices.
SLICE, TASK = 1 << 18, 1 << 20
#: Removes the shuffle files of a query when it ends; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Nothing that is shuffled for the jobs within stays on disk when they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _numbered(index: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """(``member, number`` of the members that are frequent, ``number, owner`` of their listings)."""
    listed = written(index.select("member", "owner").where("member IS NOT NULL AND owner IS NOT NULL").distinct(), "pair-index")
    often = listed.groupBy("member").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    kept = written(often.select("member", F.monotonically_increasing_id().alias("id")), "pair-members")
    # An id is a partition and a row in it; by row first, the numbers have hardly a gap.
    parts = (kept.agg(F.max(F.shiftright("id", 33)).alias("last")).first()["last"] or 0) + 1
    members = kept.select("member", (F.col("id").bitwiseAND(F.lit((1 << 33) - 1)) * parts + F.shiftright("id", 33)).alias("number"))
    return members, written(listed.join(members, "member").select("number", "owner"), "pair-listings")


def _slices(listings: DataFrame, tasks: int, groups: int, width: int) -> DataFrame:
    """``slice, group, wide, sizes, held``: for every slice of whole lists and every group with members in it, how many
    members of the group each list holds (numbers of ``wide`` bytes) and these, as ``number // groups`` below ``width``."""
    kind = np.min_scalar_type(width - 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0

        def done() -> pa.RecordBatch:
            number, first = np.concatenate(numbers), np.concatenate(firsts)
            place = np.cumsum(first) - 1
            group = (number % groups).astype(np.min_scalar_type(groups))
            order = np.argsort(group, kind="stable")
            place, held = place[order], (number[order] // groups).astype(kind)
            ends, rows = np.cumsum(np.bincount(group, minlength=groups)), []
            for g, (at, end) in enumerate(zip([0, *ends[:-1]], ends)):
                if at < end:
                    sizes = np.bincount(place[at:end], minlength=place.max() + 1)
                    sizes = sizes.astype(np.min_scalar_type(sizes.max()))
                    rows.append((task + made, g, sizes.itemsize, sizes.tobytes(), held[at:end].tobytes()))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["slice", "group", "wide", "sizes", "held"])

        numbers, firsts, size = [], [], 0
        for batch in batches:
            number, first = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(first)
            if size >= SLICE and len(starts):
                numbers.append(number[: starts[0]])
                firsts.append(first[: starts[0]])
                yield done()
                number, first = number[starts[0] :], first[starts[0] :]
                numbers, firsts, size, made = [], [], 0, made + 1
            numbers.append(number)
            firsts.append(first)
            size += len(number)
        if size:
            yield done()

    first = F.row_number().over(Window.partitionBy("owner").orderBy("number")) == 1
    ordered = listings.repartition(tasks, "owner").select("number", first.alias("first"))
    return ordered.mapInArrow(cut, "slice bigint, group int, wide int, sizes binary, held binary")


def _met(slices: DataFrame, groups: int, width: int, low: int, high: int) -> DataFrame:
    """The rows of the slices for the cells from ``low`` to below ``high``: cell ``j * (j + 1) / 2 + i`` has groups ``i <= j``."""
    other, group = F.col("other"), F.col("group")
    i, j = F.least(group, other), F.greatest(group, other)
    cell = (j * (j + 1) / 2).cast("int") + i
    dealt = slices.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("other")).where((cell >= low) & (cell < high))
    dealt = dealt.select(i.alias("i"), j.alias("j"), "slice", (group > other).alias("right"), "wide", "sizes", "held", F.lit(groups).alias("groups"), F.lit(width).cast("bigint").alias("width"))
    cells = (F.col("j") * (F.col("j") + 1) / 2).cast("int") + F.col("i")
    return dealt.repartitionById(high - low, cells - low).sortWithinPartitions("j", "i", "slice", "right")


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int, int], np.ndarray]]:
    """(``i, j, groups, width`` of a cell, codes ``x * width + y`` of pairs in it), cell after cell: each pair of each list
    once, where ``x`` and ``y`` are the members' numbers in their groups."""
    cell = left = None
    for batch in batches:
        columns = [c if pa.types.is_binary(c.type) else c.to_pylist() for c in batch.columns]
        for i, j, at, right, wide, sizes, held, groups, width in zip(*columns):
            if cell != (i, j, groups, width):
                cell, left = (i, j, groups, width), None
            sizes, held = np.frombuffer(sizes.as_buffer(), f"u{wide}"), np.frombuffer(held.as_buffer(), np.min_scalar_type(width - 1))
            if not right:
                left = (at, np.repeat(np.arange(len(sizes)), sizes), held)
            if right != (i < j) or left is None or left[0] != at:
                continue
            # The members that each of the left ones meets: of its list's in the right group all, in its own those after it.
            ends = np.cumsum(sizes, dtype=np.int64)[left[1]]
            begins = ends - sizes[left[1]] if i < j else np.arange(1, len(held) + 1)
            kind = np.uint32 if width * width <= 1 << 32 else np.uint64
            times = ends - begins
            total = np.cumsum(times)
            place = 0
            while place < len(times):
                end = max(place + 1, int(np.searchsorted(total, (total[place - 1] if place else 0) + CHUNK, "right")))
                some = times[place:end]
                meets = np.arange(some.sum()) + np.repeat(begins[place:end] - np.cumsum(some) + some, some)
                if len(meets):
                    yield cell, np.repeat(left[2][place:end].astype(kind) * kind(width), some) + held[meets]
                place = end


def _names(cell: tuple[int, int, int, int], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``x, y``: the numbers of the pairs' members, the lower first."""
    i, j, groups, width = cell
    codes = codes.astype(np.uint64)
    x, y = ((codes // np.uint64(width)).astype(np.int64) * groups + i, (codes % np.uint64(width)).astype(np.int64) * groups + j)
    return np.minimum(x, y), np.maximum(x, y)


def _batches(names: list[str], columns: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)], pa.int64()) for c in columns], names=names)


def _pairs(met: DataFrame) -> DataFrame:
    """``x, y`` with ``x < y``: a row for each pair of each list (nothing holds a list's pairs)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, codes in _codes(batches):
            yield from _batches(["x", "y"], _names(cell, codes))

    return met.mapInArrow(made, "x bigint, y bigint")


def _added(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of sorted ones, with the sums of their times."""
    starts = np.flatnonzero(np.concatenate([[True] * (len(codes) > 0), codes[1:] != codes[:-1]]))
    return codes[starts], np.add.reduceat(times, starts)


def _often(pending: list[np.ndarray], folded: tuple[np.ndarray, np.ndarray] | None, need: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes that occur ``need`` times or more, with their times; ``folded``: distinct codes that were counted before."""
    codes = np.concatenate(pending) if pending else folded[0][:0]
    pending.clear()
    codes.sort()
    if folded is not None or need < 2:
        codes, times = _added(codes, np.ones(len(codes), np.int32))
        if folded is not None:
            codes, times = np.concatenate([folded[0], codes]), np.concatenate([folded[1], times])
            order = np.argsort(codes, kind="stable")
            codes, times = _added(codes[order], times[order])
        keep = times >= need
        return codes[keep], times[keep]
    # A sorted code occurs so often if the same one is that far behind its first place; nothing is made for the others.
    far = codes[need - 1 :] == codes[: max(0, len(codes) - need + 1)]
    far[1:] &= codes[1 : len(far)] != codes[: max(0, len(far) - 1)]
    at = np.flatnonzero(far)
    return codes[at], np.searchsorted(codes, codes[at], "right") - at


def _pair_counts(met: DataFrame, need: int) -> DataFrame:
    """``x, y, n`` with ``x < y``: the pairs that ``n >= need`` lists hold, counted in the tasks. All occurrences of a pair
    are in one cell and all rows of a cell in one task, so there is one row for a pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[pa.RecordBatch]:
            codes, times = _often(pending, folded, need)
            yield from _batches(["x", "y", "n"], (*_names(now, codes), times.astype(np.int64)))

        now, pending, size, folded = None, [], 0, None
        for cell, codes in _codes(batches):
            if cell != now:
                if now is not None:
                    yield from found()
                now, size, folded = cell, 0, None
            pending.append(codes)
            size += len(codes)
            if size >= max(FOLD, len(folded[0]) if folded else 0):
                folded, size = _often(pending, folded, 1), 0
        if now is not None:
            yield from found()

    return met.mapInArrow(count, "x bigint, y bigint, n bigint")


def _candidates(listings: DataFrame, last: int, support: int, block: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(``x, y, n``: the pairs that reach the need in the lists not set aside, ``owner`` of those set aside)."""
    sizes = written(listings.groupBy("owner").agg(F.count(F.lit(1)).alias("size")), "pair-sizes")
    aside = support // 2
    hot = written(sizes.where(F.col("size") > block).orderBy(F.desc("size"), "owner").limit(aside).select("owner"), "pair-hot")
    need = support - hot.count()  # at most support // 2 rows were kept
    others = listings.join(hot, "owner", "left_anti")
    size = F.col("size").cast("double")
    whole = sizes.join(hot, "owner", "left_anti").agg(F.sum("size").alias("listings"), F.sum(size * (size - 1) / 2).alias("made")).first()
    listed, made = whole["listings"] or 0, whole["made"] or 0
    ctx = context(listings.sparkSession)
    cores = ctx.defaultParallelism if ctx is not None else 8
    groups = 1
    while groups * groups < 2 * made / CELL or groups * (groups + 1) // 2 < min(2 * cores, made / SLICE) or last // groups >= 1 << 32:
        groups += 1
    width, cells = last // groups + 1, groups * (groups + 1) // 2
    slices = written(_slices(others, max(-(-listed // TASK), min(cores, listed // SLICE + 1)), groups, width), "pair-slices")
    bucket = F.pmod(F.xxhash64("x", "y"), F.lit(buckets)).alias("bucket")
    full = None
    if made < 2.0 * need * buckets:  # else the mean bucket reaches the need twice over, and hardly one would go
        pairs = _pairs(_met(slices, groups, width, 0, cells))
        full = written(pairs.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= need).select("bucket"), "pair-buckets")
    rounds = []
    for low in range(0, cells, 4 * cores):
        reach = _pair_counts(_met(slices, groups, width, low, min(cells, low + 4 * cores)), need)
        if full is not None:
            reach = reach.withColumn("bucket", bucket).join(F.broadcast(full), "bucket", "left_semi")
        rounds.append(written(reach.select("x", "y", "n"), "pair-candidates"))
    return reduce(DataFrame.unionByName, rounds), hot


def frequent_pairs(index: DataFrame, support: int, block: int = BLOCK, buckets: int = BUCKETS) -> DataFrame:
    """``a, b, n``: the pairs ``a < b`` of members that ``n >= support`` owners list.

    ``index`` holds ``member`` (of an orderable type) and ``owner``.
    """
    support = max(1, int(support))
    with _cleaned(index.sparkSession):
        members, listings = _numbered(index, support)
        last = members.agg(F.max("number").alias("last")).first()["last"] or 0
        candidates, hot = _candidates(listings, last, support, block, buckets)
    # The lists set aside: each candidate's lists with x, of which those with y too stay.
    held = listings.join(hot, "owner", "left_semi")
    first = candidates.select("x", "y").join(held.select(F.col("number").alias("x"), "owner"), "x")
    more = first.join(held.select(F.col("number").alias("y"), "owner"), ["y", "owner"], "left_semi").groupBy("x", "y").agg(F.count(F.lit(1)).alias("more"))
    total = candidates.join(more, ["x", "y"], "left").select("x", "y", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n")).where(F.col("n") >= support)
    named = total.join(members.select(F.col("number").alias("x"), F.col("member").alias("_x")), "x").join(members.select(F.col("number").alias("y"), F.col("member").alias("_y")), "y")
    return named.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "n")
