"""N-gram Jaccard join by MinHash bands, verified on the full n-gram sets.

A document's set holds the hashes (64 bits) of its distinct runs of ``NGRAM`` words; one with fewer
words has one run of them all. Words are the runs of letters, marks and digits of the lower-cased
text, as an edited copy often has its sentences cut and capitalised anew. Documents with the same
words are one node. Each node's MinHash
signature is cut into bands; the numbers of bands and of rows in a band follow from the similarity
and the recall asked for. Nodes are shuffled on their band hashes, and within a band's bucket
linked to its smallest node only, never all pairs. The connected components of these
candidate links hold every pair that shares a band, and are the unit of verification: the texts of
a component meet in one task, where an inverted index over their sets counts the overlap of every
pair, and leave as one row per document with its number of links and its class. A component beyond
``TASK_WORDS`` is split by set size and hash into blocks; only blocks whose sizes allow the
similarity meet, and a task still holds two blocks.

A document's links are all other rows at or above the similarity, copies included, and a class is
a connected component of links; its id is the smallest id in it.

Results for odd input: a null or empty text, or one without a word, has no n-grams, no links, and is its own class; so is
each row with a null id, whose class is null. Rows that repeat are copies and count as links of
each other. Ids name documents: rows that share an id but not the text are linked as one node. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import code_points, cut, mix64, per_worker, text_blocks, word_hashes
from postlens.llm.components import connected_components

NGRAM = 5
SIMILARITY = 0.8
#: Share of the pairs just at the similarity that the bands must find.
RECALL = 0.9995
#: Most hashes of a signature.
HASHES = 160
#: Words in the documents of one task.
TASK_WORDS = 1 << 18
SEED = 77
#: Rows whose texts are read together.
ROWS = 128


def choose_bands(similarity: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows in a band, so the fewest false candidates, whose bands reach the recall within ``hashes``."""
    best = (max(1, hashes), 1)
    for rows in range(1, hashes + 1):
        share = similarity**rows
        bands = 1 if share >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - share))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


#: Code points from here on are taken as they are.
_TABLE_END = 0x30000


def word_table() -> np.ndarray:
    """Code point -> its lower-case letter, mark or digit; anything else -> a space."""
    out = np.full(_TABLE_END, 32, dtype=np.uint32)
    for c in range(_TABLE_END):
        char = chr(c)
        if char.isalnum() or unicodedata.category(char)[0] == "M":
            low = char.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def shingles(texts: list[str | None], n: int = NGRAM) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """(hashes, starts, digests, words): the n-gram hashes of all texts, those of text i from ``starts[i]`` to ``starts[i + 1]``.

    A digest names a sequence of words. A word of more than a block of characters counts as several.
    """
    table = per_worker("words", word_table)
    hashes, owner = [], []
    for rows, strings in text_blocks(texts):
        points, starts = code_points(strings)
        found, begin = word_hashes(np.where(points < _TABLE_END, table[np.minimum(points, _TABLE_END - 1)], points))
        hashes.append(found)
        owner.append(rows[np.searchsorted(starts, begin, side="right") - 1])
    words = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    row = np.concatenate(owner) if owner else np.zeros(0, dtype=np.int64)
    number = np.bincount(row, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(number)))
    digests = [hashlib.blake2b(words[first[i] : first[i + 1]].tobytes(), digest_size=16).digest() for i in range(len(texts))]
    grams = np.where(number >= n, number - n + 1, np.minimum(number, 1))
    starts = np.concatenate(([0], np.cumsum(grams)))
    out = np.zeros(starts[-1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        factors = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(n)]
        if len(words) >= n:
            rolled = np.zeros(len(words) - n + 1, dtype=np.uint64)
            for k in range(n):
                rolled += words[k : k + len(rolled)] * factors[k]
            out[np.repeat(number >= n, grams)] = rolled[row[: len(rolled)] == row[n - 1 :]]
        for i in np.flatnonzero((number > 0) & (number < n)):
            some = words[first[i] : first[i + 1]]
            out[starts[i]] = (some * np.array(factors[: len(some)])).sum(dtype=np.uint64) + np.uint64(len(some))
    return mix64(out), starts, digests, number


def band_keys(hashes: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts x bands) hashes of the bands; every text must have an n-gram."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    begin = starts[:-1]
    keys = np.zeros((len(begin), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            key = np.full(len(begin), band + 1, dtype=np.uint64)
            for factor in factors[band * rows : (band + 1) * rows]:
                v = low * factor
                v ^= v >> np.uint32(16)
                v *= np.uint32(0x85EBCA6B)
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, begin))
            keys[:, band] = key
    return keys


def signatures(docs: DataFrame, similarity: float, recall: float) -> DataFrame:
    """(id, digest, words, grams, keys): of every row the digest of its words, the numbers of its words and distinct n-grams, and its band hashes."""
    bands, rows = choose_bands(similarity, recall)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                hashes, starts, digests, number = shingles(part.column(1).to_pylist())
                some = np.diff(starts) > 0
                keys = band_keys(hashes, np.append(starts[:-1][some], starts[-1]), bands, rows) if some.any() else np.zeros((0, bands), dtype=np.uint64)
                edges = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
                grams = [len(np.unique(hashes[starts[i] : starts[i + 1]])) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(digests, pa.binary()),
                        pa.array(number, pa.int64()),
                        pa.array(grams, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.ravel().view(np.int64))),
                    ],
                    names=["id", "digest", "words", "grams", "keys"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(scan, f"id {kind}, digest binary, words bigint, grams bigint, keys array<bigint>")


def linked(sets: list[np.ndarray], side: np.ndarray | None, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """For every set the others at or above the similarity; with sides, those of the other side only."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    begin = np.flatnonzero(new)
    number = np.diff(np.append(begin, len(ranked)))
    gram = np.empty(len(grams), dtype=np.int64)
    gram[order] = np.cumsum(new) - 1
    holders = owner[order]
    first = np.concatenate(([0], np.cumsum(size)))
    for i in range(m):
        mine = gram[first[i] : first[i + 1]]
        mine = mine[number[mine] > 1]
        n = number[mine]
        place = np.repeat(begin[mine] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        shared = np.bincount(holders[place], minlength=m)
        # overlap / union >= t, without division
        near = shared * (1 + similarity) >= similarity * (size[i] + size) - 1e-9
        near &= shared > 0
        near[i] = False
        if side is not None:
            near &= side != side[i]
        yield i, np.flatnonzero(near)


def verify(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """(node, links, mate) of the documents of one component or pair of blocks; ``mate`` is a node of the same class in it."""
    hashes, starts, _, _ = shingles(frame["text"].tolist())
    sets = [np.unique(hashes[starts[i] : starts[i + 1]]) for i in range(len(frame))]
    copies = frame["copies"].to_numpy()
    alone = frame["left"].iloc[0] == frame["right"].iloc[0]  # a block with itself
    label = np.arange(len(sets))
    links = np.zeros(len(sets), dtype=np.int64)
    for i, others in linked(sets, None if alone else frame["side"].to_numpy(), similarity):
        links[i] = copies[others].sum()
        met = np.unique(label[np.append(others, i)])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    nodes = frame["node"].to_numpy()
    return pd.DataFrame({"node": nodes, "links": links, "mate": nodes[label]})


def _tasks(members: DataFrame, task_words: int) -> DataFrame:
    """(node, copies, bin, component, left, right, side): the tasks that each node takes part in."""
    whole = members.groupBy("component").agg(F.sum("words").alias("sum_words"))
    sized = cut(members.join(whole, "component"), "jaccard-members")
    small = sized.where(F.col("sum_words") <= task_words)
    bins = max(1, -(-(small.agg(F.sum("words")).first()[0] or 0) // task_words))
    none = F.lit(0).cast("long")
    packed = small.select("node", "copies", F.pmod(F.xxhash64("component"), F.lit(bins)).alias("bin"), "component", none.alias("left"), none.alias("right"), F.lit(0).alias("side"))
    # Beyond that: blocks by size class and hash. Sets at or above the similarity are at most one class apart.
    large = sized.where(F.col("sum_words") > task_words)
    cells = large.groupBy("component", "rank").agg(F.sum("words").alias("cell_words")).withColumn("blocks", F.ceil(F.col("cell_words") * 2 / task_words).cast("long"))
    other = cells.select("component", F.col("rank").alias("other"), F.col("blocks").alias("other_blocks"))
    meets = cells.join(other, "component").where(F.abs(F.col("rank") - F.col("other")) <= 1)
    block = F.pmod(F.xxhash64("node", F.lit(9)), F.col("blocks"))
    mine = F.struct(F.col("rank").alias("rank"), F.col("block").alias("block"))
    theirs = F.struct(F.col("other").alias("rank"), F.col("other_block").alias("block"))
    dealt = (
        large.join(meets, ["component", "rank"])
        .withColumn("block", block)
        .withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1)))
        .select("node", "copies", "component", F.least(mine, theirs).alias("a"), F.greatest(mine, theirs).alias("b"), F.when(mine > theirs, 1).otherwise(0).alias("side"))
        .select("node", "copies", F.xxhash64("component", "a", "b").alias("bin"), "component", F.xxhash64("a").alias("left"), F.xxhash64("b").alias("right"), "side")
    )
    return packed.unionByName(dealt)


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    task_words: int = TASK_WORDS,
) -> DataFrame:
    """(id, class_id, n_links) of every row of ``docs``."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    signed = cut(signatures(texts, similarity, recall), "jaccard-signatures")
    named = signed.where("id is not null and words > 0")
    nodes = cut(named.groupBy("digest").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.max("words").alias("words"), F.max("grams").alias("grams")), "jaccard-nodes")
    # Band buckets of the nodes: the smallest node of each is partial-aggregated before the shuffle.
    keyed = named.join(nodes.select("digest", "node"), "digest").where("id = node").select("node", F.posexplode("keys").alias("band", "key")).distinct()
    buckets = keyed.groupBy("band", "key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = keyed.join(buckets, ["band", "key"]).select(F.col("node").alias("u"), F.col("least").alias("v"))
    candidates = connected_components(edges)
    rank = F.floor(F.log(F.col("grams").cast("double")) / (-math.log(similarity) * (1 + 1e-9))).cast("long")
    members = candidates.join(nodes.groupBy("node").agg(F.sum("copies").alias("copies"), F.max("words").alias("words"), F.max(rank).alias("rank")), "node")
    tasks = _tasks(members, task_words)
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    full = texts.join(tasks, texts["id"] == tasks["node"]).select("bin", "component", "left", "right", "side", "node", "copies", "text")

    def check(_key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["node", "text"]).drop_duplicates(["component", "left", "right", "node"])
        return pd.concat([verify(part, similarity) for _, part in frame.groupby(["component", "left", "right"], sort=False)])

    checked = cut(full.groupBy("bin").applyInPandas(check, f"node {kind}, links bigint, mate {kind}"), "jaccard-checked")
    classes = connected_components(checked.select(F.col("node").alias("u"), F.col("mate").alias("v")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(links, "node", "left").join(classes, "node", "left").select(
        F.col("digest"), F.coalesce("component", "node").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")
    )
    return (
        signed.withColumn("digest", F.when(F.expr("id is not null and words > 0"), F.col("digest")))
        .select("id", "digest")
        .join(known, "digest", "left")
        .select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    )


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id names their class, so one document of each class; rows with a null id stay."""
    joined = jaccard_join(docs, id_col, text_col, similarity)
    gone = joined.where(F.col(id_col) != F.col("class_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
