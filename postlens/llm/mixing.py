"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a share of a word budget by its weight, up to ``CAP`` times its own words; what it
cannot use is shared anew among the others. Whole copies of a source are taken as often as they
fit. What remains of its target is filled exactly: its documents are counted by length, every
length gives its proportional part, rounded down, and bounded-knapsack dynamic programming over the
documents left of each length picks the lengths whose sum is the rest. Documents of a length are
then taken in the order of a seeded hash.

The work on documents is one pass that counts words and one range sort of (source, length, hash);
a hot source or length spans many ranges, and its documents are numbered by adding the counts of
earlier ranges. The programming sees one row per source and length, and its budget is bounded by
``RESERVE`` and the longest document.

Results for odd input: a null or empty text has size 0, is taken with 0 words and never changes a
sum; a null source is a source of its own and sorts last; a source without words has target 0;
rows that repeat are documents of their own; null ids are hashed as null; an empty table gives an
empty result. Other columns are ignored, or kept by :func:`mixed_documents`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import WORD_CLASS, cut, shuffle_partitions, text_or_empty
from postlens.operators.rank import row_number_within

#: Weights of the sources in the order of their names, repeating (fixed by the query's contract).
WEIGHTS = (3, 1, 2)
#: Budget as a share of all words, and the most of a source's words that its target may be.
BUDGET = 1.5
CAP = 2.0
#: Words that the dynamic programming leaves open, besides one document's.
RESERVE = 1 << 15
SEED = 41
_POS_BITS = 33


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(f"{WORD_CLASS}+")).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """(nil, source, source_size, target) from (nil, source, source_size); ``nil`` marks the null source.

    Sharing goes in rounds: with the level that the open sources share the rest at, those whose
    share exceeds their cap are closed. A round is one aggregate of two sums.
    """
    ranked = row_number_within(sources, [], [F.col("nil"), F.col("source")], "place")
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighted = cut(ranked.select("nil", "source", "source_size", choice.alias("weight"), (F.col("source_size") * cap).alias("most")), "mix-sources")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, closed = 0.0, -1
    while True:
        above = F.col("weight") * level > F.col("most")
        spent, open_weight, now = weighted.agg(F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if now == closed or not open_weight:
            break
        closed, level = now, (budget * total - (spent or 0.0)) / open_weight
    return weighted.select("nil", "source", "source_size", F.least(F.col("weight") * level, F.col("most")).cast("double").alias("target"))


def knapsack(lengths: Sequence[int], counts: Sequence[int], budget: int) -> dict[int, int]:
    """How many of each length to take so that their sum is ``budget``, or as near below as can be.

    Reachable sums are the bits of one integer. A length that may be used c times becomes pieces
    of 1, 2, 4, ... of it; a sum remembers the piece that first reached it, so that the pieces of
    any sum can be read back.
    """
    if budget <= 0:
        return {}
    mask = (1 << (budget + 1)) - 1
    reach, size = 1, budget // 8 + 1
    first = np.full(budget + 1, -1, dtype=np.int64)
    pieces: list[tuple[int, int]] = []
    for length, count in zip(lengths, counts):
        times = 1
        left = min(count, budget // length) if length > 0 else 0
        while left > 0 and not reach >> budget & 1:
            times = min(times, left)
            new = (reach << (length * times)) & mask & ~reach
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(size, "little"), dtype=np.uint8), bitorder="little")
                first[np.flatnonzero(bits[: budget + 1])] = len(pieces)
                reach |= new
            pieces.append((length, times))
            left -= times
            times *= 2
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    taken: dict[int, int] = {}
    while at > 0:
        length, times = pieces[first[at]]
        taken[length] = taken.get(length, 0) + times
        at -= length * times
    return taken


def fit_counts(sizes: np.ndarray, counts: np.ndarray, rest: float, reserve: int = RESERVE) -> np.ndarray:
    """How many documents of each size to take so that their words come to ``rest``."""
    total = int((sizes * counts).sum())
    chosen = np.zeros(len(sizes), dtype=np.int64)
    if total <= 0 or rest <= 0:
        return chosen
    share = min(1.0, rest / total)
    exact = counts * share
    chosen = np.minimum(np.floor(exact).astype(np.int64), counts)
    left = int(round(rest)) - int((chosen * sizes).sum())
    # One more of the lengths that lost most by rounding, while more than the reserve is open.
    for i in np.lexsort((sizes, chosen - exact)):
        if sizes[i] > 0 and chosen[i] < counts[i] and left - sizes[i] >= reserve:
            chosen[i] += 1
            left -= int(sizes[i])
    place = {int(s): i for i, s in enumerate(sizes)}
    order = np.argsort(-sizes, kind="stable")
    for length, times in knapsack(sizes[order].tolist(), (counts - chosen)[order].tolist(), left).items():
        chosen[place[length]] += times
    return chosen


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """(id, text_hash, size, source_size, target, copies, taken) of every row of ``docs``."""
    partitions = shuffle_partitions(docs.sparkSession)
    source = F.col(f"`{source_col}`").cast("string")
    rows = cut(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
            source.isNull().alias("nil"),
            F.coalesce(source, F.lit("")).alias("source"),
            word_count(text_col).alias("size"),
        ).withColumn("draw", F.xxhash64(F.lit(seed), "id", "text_hash")),
        "mix-rows",
    )
    lengths = cut(rows.groupBy("nil", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    sources = lengths.groupBy("nil", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources, weights)

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size").reset_index(drop=True)
        whole, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
        base = int(target // whole) if whole else 0
        chosen = fit_counts(frame["size"].to_numpy(dtype=np.int64), frame["n"].to_numpy(dtype=np.int64), target - base * whole)
        return frame[["nil", "source", "size", "source_size", "target"]].assign(base=base, chosen=chosen)

    chosen = (
        lengths.join(targets, ["nil", "source"])
        .groupBy("nil", "source")
        .applyInPandas(choose, "nil boolean, source string, size bigint, source_size bigint, target double, base bigint, chosen bigint")
    )
    order = ["nil", "source", "size", "draw", "id"]
    tagged = cut(
        rows.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("mark", F.monotonically_increasing_id())
        .withColumn("part", F.shiftrightunsigned("mark", _POS_BITS))
        .withColumn("pos", F.col("mark").bitwiseAND(F.lit((1 << _POS_BITS) - 1))),
        "mix-tagged",
    )
    earlier = Window.partitionBy("nil", "source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        tagged.groupBy("part", "nil", "source", "size")
        .agg(F.min("pos").alias("begin"), F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .drop("n")
        .join(chosen, ["nil", "source", "size"])
    )
    placed = tagged.join(ranges, ["part", "nil", "source", "size"])
    copies = F.col("base") + (F.col("before") + F.col("pos") - F.col("begin") < F.col("chosen")).cast("long")
    return placed.select(F.col("id").alias(id_col), "text_hash", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it.

    Rows that are equal in id and text get their decisions in any order.
    """
    key = ["_id", "_hash"]
    made = mix(docs, id_col, text_col, source_col, weights).select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"), F.col("copies").cast("int").alias("_copies"))
    decided = made.groupBy(*key).agg(F.sort_array(F.collect_list("_copies"), asc=False).alias("_list"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("_hash")
    ).withColumn("_number", F.row_number().over(Window.partitionBy(*key).orderBy("_hash")))
    same = rows["_id"].eqNullSafe(decided["_id"]) & (rows["_hash"] == decided["_hash"])
    taken = rows.join(decided, same).select("_row", F.explode(F.array_repeat(F.lit(0), F.element_at("_list", F.col("_number")))).alias("_copy"))
    return taken.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
