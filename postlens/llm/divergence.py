"""Source divergence audit: a frequent-pattern tree of term rows.

Each language keeps the terms that enough of its documents hold. A kept term's row is the list of the
sources that use it, in source order, each with its smoothed share ``p`` of the source's kept terms;
a source that doesn't use the term has the share of a count of zero, ``z``, and isn't in the row. For
two sources a and b, with ``f(p, q) = floor((p - q)^2 / (p + q))``, the sum of f over all kept terms is

    V f(za, zb)                                    as if no term were used
    + sum over the entries of a of f(pa, zb) - f(za, zb), and the same for b
    + sum over the rows with both of f(pa, pb) - f(pa, zb) - f(za, pb) + f(za, zb)

The second line needs only how often each share occurs in a source. The third runs over a tree: rows
are paths, inserted with their multiplicities, and a node's correction with each of its ancestors is
computed once for all rows that share the path down to it. Rows are counted first and then sorted and
range-partitioned by path, so every task walks its part of the tree depth first and holds no more than
one path and the sums of the pairs met; a node at the edge of two ranges has its multiplicity in two
parts, whose corrections add up. All arithmetic is exact.

Terms are counted in bounded tables within each task and then per (language, source, term), so neither a hot source nor
a frequent term is gathered; a term's row has one entry per source of its language, of which the
result has the square.

Results for odd input: nulls in text, language or source are read as ''; a group whose documents have
no kept term has the same share for each of them; a language that keeps no term has pair values of 0
and no terms; one with a single source has no pairs. Rows that repeat are documents of their own. An
empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import cut, text_or_empty

#: What separates terms: every ASCII character that is no letter (fixed pattern).
GAPS = bytes(c for c in range(0x80) if not chr(c).isalpha())
#: UTF-8 bytes of a text to those of its terms: A to Z in lower case, separators as spaces.
_TERM_BYTES = bytes(0x20 if c in GAPS else c for c in range(256)).lower()
MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
#: Terms that a task counts before it hands them on.
HELD_TERMS = 1 << 19
HELD_TEXTS = 1 << 20
_BITS = 42  # bits of a task's count of occurrences; HELD_TEXTS fits above them
#: Sources whose pairs a task adds up before it hands them on; pairs of wider paths go straight on.
HELD_SOURCES = 1024
#: Pairs that are worked on together.
PAIRS_AT_ONCE = 1 << 20
#: First entries of a path that its range key holds, before a hash of the whole path.
PREFIX = 4


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, dict[bytes, int]] = {}  # occurrences, and documents above the lower _BITS bits
        held = texts_read = 0

        def flush() -> list[pa.RecordBatch]:
            parts = []
            for (lang, source), uses in found.items():
                number = np.fromiter(uses.values(), dtype=np.int64, count=len(uses))
                terms = pa.array(list(uses), pa.binary()).cast(pa.string())
                made = [pa.repeat(pa.scalar(lang, pa.string()), len(uses)), pa.repeat(pa.scalar(source, pa.string()), len(uses)), terms, pa.array(number & ((1 << _BITS) - 1)), pa.array(number >> _BITS)]
                parts.append(pa.RecordBatch.from_arrays(made, names=["lang", "source", "term", "n", "docs"]))
            found.clear()
            return parts

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                uses = found.setdefault((lang, source), {})
                held -= len(uses)
                # A text's own table is small; each of its terms meets the large one once.
                for term, n in Counter(text.as_py().translate(_TERM_BYTES).split()).items():
                    uses[term] = uses.get(term, 0) + n + (1 << _BITS)
                held += len(uses)
                texts_read += 1
                if held > HELD_TERMS or texts_read >= HELD_TEXTS:
                    yield from flush()
                    held = texts_read = 0
        yield from flush()

    rows = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | int, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (n + 2) / (total + 2 kept)), in wide decimals; ``kept`` is positive."""
    n = F.lit(n) if isinstance(n, int) else n
    over = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    # A share of a present term never exceeds the scale by more than the 1 that is added.
    return F.call_function("div", over, (total + 2 * kept).cast("decimal(20,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distance(p, q):
    return (p - q) * (p - q) // (p + q)


_PAIR_DDL = "lang string, a string, b string, value bigint"


def tree_corrections(paths: DataFrame) -> DataFrame:
    """(lang, a, b, value): sums over the tree of ``paths`` (lang, path of (source, p, z), rows), a before b in source order.

    ``paths`` must come sorted within partitions, distinct ones at best.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang: str | None = None
        path: list[tuple] = []  # (source, p, z) from the root down to the current node
        rows: list[int] = []  # rows that end at or below each of its nodes, as far as they are known
        number: dict[str, int] = {}  # the language's sources met so far
        sums = np.zeros((0, 0), dtype=np.int64)
        ready: list[pa.RecordBatch] = []

        def hand_on(names: list[str], a: np.ndarray, b: np.ndarray, values: np.ndarray) -> None:
            names = pa.array(names, pa.string())
            made = [pa.array([lang] * len(values), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)), pa.array(values, pa.int64())]
            ready.append(pa.RecordBatch.from_arrays(made, names=["lang", "a", "b", "value"]))

        def flush() -> None:
            nonlocal sums
            if number:
                b, a = np.nonzero(sums)
                hand_on(list(number), a, b, sums[b, a])
            number.clear()
            sums = np.zeros((0, 0), dtype=np.int64)

        def close_to(depth: int) -> None:
            """Leaves the nodes below ``depth``: each settles with all its ancestors at once, and adds its rows to its parent's."""
            nonlocal sums
            size = len(path)
            if size == depth:
                return
            times = np.cumsum(rows[depth:][::-1])[::-1]
            p, z = (np.array([item[k] for item in path], dtype=np.int64) for k in (1, 2))
            wide = size > HELD_SOURCES
            if not wide:
                if len(number) + size > HELD_SOURCES:
                    flush()
                at = np.array([number.setdefault(item[0], len(number)) for item in path])
                if len(number) > len(sums):
                    more = max(2 * len(sums), len(number)) - len(sums)
                    sums = np.pad(sums, ((0, more), (0, more)))
            step = max(1, PAIRS_AT_ONCE // size)
            for begin in range(max(depth, 1), size, step):
                end = min(begin + step, size)
                own, none = p[begin:end, None], z[begin:end, None]
                value = _distance(p[None, :end], own) - _distance(p[None, :end], none) - _distance(z[None, :end], own) + _distance(z[None, :end], none)
                value *= times[begin - depth : end - depth, None]
                value = np.tril(value, begin - 1)  # node begin + i has the ancestors before it
                if wide:
                    b, a = np.nonzero(value)
                    hand_on([item[0] for item in path], a, b + begin, value[b, a])
                else:
                    sums[at[begin:end, None], at[None, :end]] += value
            if depth:
                rows[depth - 1] += int(times[0])
            del path[depth:], rows[depth:]

        for batch in batches:
            paths_of, items = batch.column(1), batch.column(1).flatten()
            edges = np.concatenate(([0], np.cumsum(pc.list_value_length(paths_of).to_numpy(zero_copy_only=False)))).tolist()
            entries = list(zip(*(items.field(k).to_pylist() for k in range(3))))
            for i, (row_lang, times) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                row = entries[edges[i] : edges[i + 1]]
                shared = 0
                if row_lang == lang:
                    while shared < min(len(row), len(path)) and row[shared] == path[shared]:
                        shared += 1
                close_to(shared)
                if row_lang != lang:
                    flush()
                lang = row_lang
                path += row[shared:]
                rows += [0] * (len(row) - shared)
                rows[-1] += times
                yield from ready
                ready.clear()
        close_to(0)
        flush()
        yield from ready

    return paths.select("lang", "path", "rows").mapInArrow(walk, _PAIR_DDL)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others
    (part ``pair``), and the terms that set it apart from the whole language (part ``term``)."""
    rows = docs.select(text_or_empty(f"`{text_col}`").alias("text"), text_or_empty(f"`{lang_col}`").alias("lang"), text_or_empty(f"`{source_col}`").alias("source"))
    counted = cut(term_counts(rows), "divergence-counts")
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("_docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("uses"))
    kept = cut(kept.where(F.col("_docs") >= min_docs).drop("_docs"), "divergence-kept")

    totals = kept.select("lang", F.inline("uses")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    some = F.when(F.col("kept") > 0, F.col("kept"))  # without a kept term there are no shares
    groups = cut(groups.withColumn("z", share(0, F.col("total"), some)), "divergence-groups")

    used = kept.select("lang", "term", "lang_n", F.inline("uses")).join(groups, ["lang", "source"])
    used = cut(
        used.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"), "z"),
        "divergence-shares",
    )

    # Pairs: the base and the entries of one source against the zero shares of the others, then the tree.
    others = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("y"))
    not_self = F.col("source") != F.col("item")
    base = groups.join(others, "lang").where(not_self).select("lang", "source", "item", F.coalesce(F.col("kept") * distance(F.col("z"), F.col("y")), F.lit(0)).alias("value"))
    levels = used.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("terms"))
    single = (
        levels.join(others, "lang")
        .where(not_self)
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("terms") * (distance(F.col("p"), F.col("y")) - distance(F.col("z"), F.col("y")))).alias("value"))
    )
    row = used.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "z"))).alias("path"))
    paths = row.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("rows"))
    # The sampled range keys pass through the driver: they hold a part of the path only.
    ranged = paths.repartitionByRange("lang", F.slice("path", 1, PREFIX), F.xxhash64("path")).sortWithinPartitions("lang", "path")
    both = tree_corrections(ranged)

    def mirrored(df: DataFrame, a: str, b: str) -> DataFrame:
        ends = F.array(F.struct(F.col(a).alias("source"), F.col(b).alias("item")), F.struct(F.col(b).alias("source"), F.col(a).alias("item")))
        return df.select("lang", F.inline(ends), "value")

    pairs = base.unionByName(mirrored(single, "source", "item")).unionByName(mirrored(both, "a", "b")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    terms = used.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    number = F.row_number().over(order).alias("rank")
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", number)
    best = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", number).where(F.col("rank") <= top)
    return ranked.unionByName(best)
