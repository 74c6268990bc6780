"""Helpers shared by the operators: table reads, lineage cuts, text blocks, hashed characters."""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType
from typing import TypeVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from postlens.session import shared_dir

T = TypeVar("T")

#: White space of every contract that names it: space, tab, LF, VT, FF, CR.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
_SPACES = " \t\n\v\f\r"
_SPACE = re.compile(SPACE_CLASS)
#: Characters that one block of array work holds; bounds a worker's memory for any text length.
BLOCK_CHARS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Ends the lineage: a lost executor costs a reread of these files, not a recomputation, and a
    frame used twice is computed once. The files are removed when the application's file system
    closes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/postlens-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def remainder(name: str, by: int) -> Column:
    """crc32 of the decimal text of ``name``, modulo ``by``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % by


def hash_share(name: str, seed: int) -> Column:
    """A fixed number in [0, 1) for each value of ``name``."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(name)), F.lit(1 << 20)) / float(1 << 20)


def bounded_sample(df: DataFrame, id_col: str, class_col: str, rows: int, seed: int) -> DataFrame:
    """About ``0.9 rows / classes`` rows of each class, at most ``rows`` in all, chosen by id hash.

    One count per class decides the share of each; the choice itself is a filter, so no class is
    gathered or sorted in one task, and reruns choose alike (the margin keeps the limit from
    binding). Of more classes than rows the most frequent ones are sampled.
    """
    sizes = df.groupBy(class_col).count().where(F.col(class_col).isNotNull())
    counts = {r[0]: r[1] for r in sizes.orderBy(F.desc("count"), class_col).limit(rows).collect()}
    if not counts:
        return df.limit(0)
    each = 0.9 * rows / len(counts)
    kind = df.schema[class_col].dataType
    classes = F.from_json(F.lit(json.dumps(list(counts))), ArrayType(kind))
    shares = F.from_json(F.lit(json.dumps([min(1.0, each / n) for n in counts.values()])), ArrayType(DoubleType()))
    share = F.coalesce(F.element_at(F.map_from_arrays(classes, shares), F.col(class_col)), F.lit(0.0))
    return df.where(hash_share(id_col, seed) < share).limit(rows)


def text_blocks(texts: Sequence[str | None], limit: int = BLOCK_CHARS, overlap: int = 0) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Lists of strings of about ``limit`` characters, with the row that each belongs to.

    A longer text is cut into several strings, always at white space: the last within ``limit``
    characters, else the next (a word of more than ``limit`` characters makes a longer block). Each
    of its strings begins with whole words of the one before, ``overlap`` characters or more.
    """
    rows: list[int] = []
    strings: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        text = text or ""
        at = begin = 0
        while True:
            end = len(text)
            if end - at > limit:
                space = max(text.rfind(c, at + 1, at + limit) for c in _SPACES)
                if space < 0:
                    later = _SPACE.search(text, at + limit)
                    space = later.start() if later else end
                end = space
            part = text[begin:end]
            rows.append(row)
            strings.append(part)
            size += len(part) + 1
            if size >= limit:
                yield np.array(rows, dtype=np.int64), strings
                rows, strings, size = [], [], 0
            begin = end
            if overlap:
                begin = max(at, *(text.rfind(c, at, max(at, end - overlap) + 1) for c in _SPACES))
            at = end
            if at >= len(text):
                break
    if rows:
        yield np.array(rows, dtype=np.int64), strings


def per_worker(key: str, make: Callable[[], T]) -> T:
    """What ``make`` returns, made once in each Python worker process and shared by its tasks."""
    shared = sys.modules.setdefault("_postlens_worker", ModuleType("_postlens_worker")).__dict__
    if key not in shared:
        shared[key] = make()
    return shared[key]


def code_points(strings: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the strings, a space before each and one at the end; where each begins."""
    joined = " " + " ".join(strings) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(s) + 1 for s in strings), dtype=np.int64, count=len(strings))
    starts = np.zeros(len(strings), dtype=np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return points, starts


def is_space(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points >= 9) & (points <= 13))


def mix32(h: np.ndarray) -> np.ndarray:
    """Spreads 32-bit values over all bits (in place)."""
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x7FEB352D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x846CA68B)
    h ^= h >> np.uint32(16)
    return h


def mix64(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = np.zeros(0, dtype=np.uint64)
_INVERSE = np.zeros(0, dtype=np.uint64)


def word_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each maximal run without white space, and where each run begins.

    The runs' hashes come from differences of one running polynomial sum, so no run is touched
    in Python. ``points`` must begin and end with white space.
    """
    global _POWERS, _INVERSE
    n = len(points)
    if len(_POWERS) < n:
        size = max(n, 2 * BLOCK_CHARS)
        with np.errstate(over="ignore"):
            _POWERS = np.full(size, _BASE, dtype=np.uint64)
            _POWERS[0] = 1
            np.multiply.accumulate(_POWERS, out=_POWERS)
            _INVERSE = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            _INVERSE[0] = 1
            np.multiply.accumulate(_INVERSE, out=_INVERSE)
    space = is_space(points)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, end = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _POWERS[:n], out=total[1:])
        hashes = (total[end] - total[begin]) * _INVERSE[begin]
        hashes += (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix64(hashes), begin
