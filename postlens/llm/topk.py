"""Exact top-k search in Hamming space by incremental multi-index hashing.

Of rows that share a code (64 bits) only the ``k`` with the smallest ids can be found, so only these
are searched. They are dealt into blocks by the code's hash. A block indexes its codes once per segment of
about ``log2(codes)`` bits. A query probes, segment after segment and radius after radius, the
buckets whose segment value differs from its own in exactly that many bits, and verifies the whole
codes found there. With radius ``r`` done for the first ``j + 1`` of ``m`` segments, a code that was
not found differs in more than ``m r + j`` bits (each of its segments is farther than the radius
probed for it), so the search ends once the k-th verified distance is at most that.

Every query first searches one block, chosen by its id's hash; the k-th distance found there bounds
its radius in all blocks, which return only what is as near, at most ``k`` for each query: hits
are trimmed to ``k`` step by step. The nearest of all blocks are then ranked. Where a radius has more buckets than the block has codes, the block's codes are all
verified instead, which is as exact.

Blocks and query batches have bounded sizes, so queries are sent to blocks as a stated set against
all rows; neither side is gathered as a whole.

Results for odd input: rows without a vector have no code, are not found and find nothing; null
components count as not positive; a vector of more than 64 components folds (component i toggles
bit i modulo 64); ties are ranked by id; rows that repeat are found as often; a query finds itself;
with fewer than k codes all are found. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import cut, shuffle_partitions

#: Codes in a block and queries in a batch, at most on average.
BLOCK_CODES = 1 << 17
BATCH_QUERIES = 1 << 20
#: Codes that make a block of their own while there are fewer blocks than shuffle partitions.
LEAST_BLOCK = 1 << 10
#: Probes or candidates that one step of array work holds.
STEP = 1 << 20
#: Shares in which the copies of a code are first reduced.
SHARES = 16
BITS = 64


def sign_code(vector: str) -> Column:
    """The signs of a vector's components as the bits of a 64-bit number; null for a null vector."""
    return F.expr(f"aggregate(transform(`{vector}`, (x, i) -> IF(x > 0, shiftleft(1L, i % 64), 0L)), 0L, (a, b) -> a ^ b)")


class Block:
    """The index of one block: for every segment its codes in the order of their segment values."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        width = int(min(16, max(4, round(np.log2(max(len(codes), 2))))))
        count = -(-BITS // width)
        edges = np.linspace(0, BITS, count + 1).round().astype(int)
        self.segments = list(zip(edges[:-1].tolist(), np.diff(edges).tolist()))
        self.tables = []
        for low, size in self.segments:
            values = self.part(codes, low, size)
            starts = np.concatenate(([0], np.cumsum(np.bincount(values, minlength=1 << size))))
            self.tables.append((np.argsort(values, kind="stable"), starts))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def part(codes: np.ndarray, low: int, size: int) -> np.ndarray:
        return ((codes >> np.uint64(low)) & np.uint64((1 << size) - 1)).astype(np.int64)

    def flips(self, size: int, radius: int) -> np.ndarray:
        """All values of ``size`` bits with ``radius`` of them set."""
        if (size, radius) not in self.masks:
            self.masks[size, radius] = np.array([sum(1 << b for b in c) for c in combinations(range(size), radius)], dtype=np.int64)
        return self.masks[size, radius]

    def probe(self, queries: np.ndarray, segment: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, code, distance) of the codes that this segment at this radius is the first to find."""
        low, size = self.segments[segment]
        order, starts = self.tables[segment]
        flips = self.flips(size, radius)
        own = self.part(queries, low, size)
        step = max(1, STEP // len(flips))
        for at in range(0, len(queries), step):
            keys = (own[at : at + step, None] ^ flips[None, :]).ravel()
            begin, number = starts[keys], starts[keys + 1] - starts[keys]
            hit = np.flatnonzero(number)
            begin, number = begin[hit], number[hit]
            ends = np.cumsum(number)
            split = np.searchsorted(ends, np.arange(STEP, (ends[-1] if len(ends) else 0) + STEP, STEP))
            left = 0
            for right in split + 1:
                some, first = number[left:right], begin[left:right]
                if len(some):
                    place = np.repeat(first - np.concatenate(([0], np.cumsum(some)[:-1])), some) + np.arange(some.sum())
                    code = order[place]
                    query = np.repeat(hit[left:right] // len(flips) + at, some)
                    differ = queries[query] ^ self.codes[code]
                    fresh = np.ones(len(code), dtype=bool)
                    for other, (lo, n) in enumerate(self.segments):
                        if other != segment:
                            apart = np.bitwise_count((differ >> np.uint64(lo)) & np.uint64((1 << n) - 1))
                            fresh &= (apart >= radius) if other > segment else (apart > radius)
                    yield query[fresh], code[fresh], np.bitwise_count(differ[fresh]).astype(np.int64)
                left = right

    def whole(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, code, distance) of all pairs, in steps."""
        step = max(1, STEP // max(1, len(self.codes)))
        for at in range(0, len(queries), step):
            apart = np.bitwise_count(queries[at : at + step, None] ^ self.codes[None, :]).astype(np.int64)
            query, code = np.indices(apart.shape)
            yield query.ravel() + at, code.ravel(), apart.ravel()

    def nearest(self, queries: np.ndarray, bounds: np.ndarray, k: int, ties: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance) of everything within each query's bound that may be among its k nearest.

        Without ``ties`` those of equal distance are ranked by their place in ``codes``, and a query
        has at most ``k``. Hits are merged in steps, so between steps no query holds more than that.
        """
        # A hit is one number: query, distance (8 bits), place of the code (32 bits).
        first = np.arange(len(queries) + 1, dtype=np.int64) << 40
        last = first[:-1] + (np.minimum(bounds, BITS).astype(np.int64) << 32) + 0xFFFFFFFF  # of each query, what may still count
        held = np.zeros(0, dtype=np.int64)
        open_ = np.arange(len(queries))

        def limit() -> np.ndarray:
            return (last >> 32) & 0xFF

        def merge(parts: list[np.ndarray]) -> None:
            nonlocal held
            held = np.concatenate((held, *parts))
            held.sort()
            starts = np.searchsorted(held, first)
            full = np.flatnonzero(np.diff(starts) >= k)
            kth = held[starts[full] + k - 1]
            last[full] = np.minimum(last[full], kth | 0xFFFFFFFF if ties else kth)
            held = held[held <= last[held >> 40]]

        def take(hits: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
            parts, size = [], 0
            for query, code, apart in hits:
                query = open_[query]
                found = first[query] + (apart << 32) + code
                parts.append(found[found <= last[query]])
                size += len(parts[-1])
                if size >= STEP:
                    merge(parts)
                    parts, size = [], 0
            merge(parts)

        covered, radius, m = -1, 0, len(self.segments)
        while len(open_) and covered < BITS:
            if len(self.codes) <= max(k, len(self.flips(self.segments[0][1], radius))):
                closed = np.ones(len(queries), dtype=bool)  # all codes follow for the open queries
                closed[open_] = False
                held = held[closed[held >> 40]]
                take(self.whole(queries[open_]))
                break
            for segment in range(m):
                take(self.probe(queries[open_], segment, radius))
                covered = m * radius + segment
                open_ = open_[limit()[open_] > covered]
                if not len(open_):
                    break
            radius += 1
        return held >> 40, held & 0xFFFFFFFF, (held >> 32) & 0xFF


def first_copies(codes: DataFrame, k: int) -> DataFrame:
    """Of every code the ``k`` rows with the smallest ids: no others can be among the ``k`` nearest of any query.

    Copies are first reduced in ``SHARES`` shares by id, so a hot code is not read by one task.
    """
    share = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(SHARES))
    for keys in (["code", share], ["code"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
        codes = codes.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
    return codes


def search(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, distance): the ``k`` nearest codes of every query, ties by id.

    Both frames have the columns ``id`` and ``code``.
    """
    spark = codes.sparkSession
    codes, queries = cut(first_copies(codes.where("code is not null").select("id", "code"), k), "codes"), cut(queries.where("code is not null").dropDuplicates(["id", "code"]), "queries")
    n, asked = codes.count(), queries.count()
    blocks = max(1, -(-n // BLOCK_CODES), min(shuffle_partitions(spark), -(-n // LEAST_BLOCK)))
    batches = max(1, -(-asked // BATCH_QUERIES))
    schema = f"query_id {codes.schema['id'].dataType.simpleString()}, id {codes.schema['id'].dataType.simpleString()}, distance int"

    def nearest(_key: tuple, code_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(code_rows) or not len(query_rows):
            return pd.DataFrame({"query_id": [], "id": [], "distance": []})
        code_rows = code_rows.sort_values("id", na_position="first")  # equal distances are ranked by id
        block = Block(code_rows["code"].to_numpy(dtype=np.int64).view(np.uint64))
        asked = query_rows["code"].to_numpy(dtype=np.int64).view(np.uint64)
        query, code, apart = block.nearest(asked, query_rows["bound"].to_numpy(dtype=np.int64), k, ties=False)
        return pd.DataFrame({"query_id": query_rows["id"].to_numpy()[query], "id": code_rows["id"].to_numpy()[code], "distance": apart})

    def within(code_rows: DataFrame, query_rows: DataFrame) -> DataFrame:
        return code_rows.groupBy("block", "batch").cogroup(query_rows.groupBy("block", "batch")).applyInPandas(nearest, schema)

    block = lambda name: F.pmod(F.xxhash64(name), F.lit(blocks)).alias("block")
    batch = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(batches)).alias("batch")
    every = lambda number, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias(name)
    dealt = codes.select("id", "code", block("code"), every(batches, "batch"))
    # First one block each, by id as many queries may share a code, for a bound.
    home = within(dealt, queries.select("id", "code", block("id"), batch, F.lit(BITS).cast("long").alias("bound")))
    bounds = home.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").cast("long").alias("far")).where(F.col("n") >= k)
    asked_all = queries.join(bounds, queries["id"] == bounds["query_id"], "left").select(
        "id", "code", F.coalesce("far", F.lit(BITS)).cast("long").alias("bound"), every(blocks, "block"), batch
    )
    near = within(dealt, asked_all)
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("long").alias("rank"), "id", F.col("distance").cast("long").alias("distance"))
