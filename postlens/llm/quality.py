"""Quality classifier: hashed word and character n-gram vectors, averaged, under a softmax.

Each word, pair of words and character n-gram of a document is hashed to one of ``2**bits``
vectors; the document is their mean, and a softmax layer over it gives the class probabilities.
Vectors and layer are learned together by stochastic gradient descent in numpy, on a bounded sample
of labelled documents (``sample_rows``, chosen evenly from the classes by id hash), whose hashed
features are computed by Spark tasks. Scoring needs one number per feature, as the layer is
linear in the mean, and reads every whole text in one pass.

Results for odd input: a null or empty text has no features and scores by the layer's offsets
alone; texts of any length are scored in blocks; repeated rows get equal scores; unlabelled rows
and null or other labels than 0 and 1 are not learned from; of several labels of one id all count.
Without labels of both classes nothing can be learned, and every document scores 1. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import bounded_sample, code_points, is_space, mix32, text_blocks, word_hashes

BITS = 16
GRAMS = (3, 4)
DIM = 8
#: Labelled documents that the model is fitted on, at most.
SAMPLE_ROWS = 4000
#: Documents that the descent visits, whatever the size of the sample.
VISITS = 24_000
RATE = 0.2
SEED = 11
#: A feature that occurs more often than this in a learned document counts as this often.
_MOST = (1 << 16) - 1


def features(points: np.ndarray, starts: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, place) arrays of the features of a block: words, pairs of words, character n-grams.

    ``points`` and ``starts`` are from :func:`code_points`. A character n-gram lies within a word
    and the white space around it; a pair lies within one string.
    """
    shift = np.uint32(32 - bits)
    words, begin = word_hashes(points)
    low = words.astype(np.uint32)
    yield low >> shift, begin
    if len(words) > 1:
        same = np.searchsorted(starts, begin, side="right")
        pair = np.flatnonzero(same[1:] == same[:-1])
        mixed = mix32(low[pair] ^ low[pair + 1] ^ np.uint32(0x5BD1E995))  # all pairs of equal words are one feature
        yield mixed >> shift, begin[pair]
    space = is_space(points)
    chars = np.where(space, np.uint32(32), points)
    for n in GRAMS:
        size = len(chars) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n * 0x01000193, dtype=np.uint32)
        inner = np.zeros(size, dtype=bool)
        for k in range(n):
            h *= np.uint32(0x01000193)
            h ^= chars[k : k + size]
            if 0 < k < n - 1:
                inner |= space[k : k + size]
        at = np.flatnonzero(~inner)
        yield mix32(h[at]) >> shift, at


@dataclass
class Model:
    """What a feature adds to the difference of the two classes' logits, and their offset."""

    weight: np.ndarray  # float32, 2**bits
    offset: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        total, number = np.zeros(len(texts)), np.zeros(len(texts))
        for rows, strings in text_blocks(texts):
            points, starts = code_points(strings)
            sums, counts = np.zeros(len(strings)), np.zeros(len(strings))
            for bucket, place in features(points, starts):
                # Places ascend, so each string's features are one slice.
                edge = np.searchsorted(place, starts)
                running = np.concatenate(([0.0], np.cumsum(self.weight[bucket], dtype=np.float64)))
                upto = np.append(edge[1:], len(place))
                sums += running[upto] - running[edge]
                counts += upto - edge
            np.add.at(total, rows, sums)
            np.add.at(number, rows, counts)
        z = total / np.maximum(number, 1) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def document_features(docs: DataFrame, id_col: str, text_col: str, class_col: str) -> DataFrame:
    """(id, class, buckets, counts) of each row: its distinct features and how often each occurs, as packed 16-bit numbers."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for text in frame["text"]:
                counts = np.zeros(1 << BITS, dtype=np.int32)
                for _, strings in text_blocks([text]):
                    points, starts = code_points(strings)
                    for bucket, _ in features(points, starts):
                        counts += np.bincount(bucket, minlength=1 << BITS).astype(np.int32)
                used = np.flatnonzero(counts)
                found.append((used.astype(np.uint16).tobytes(), np.minimum(counts[used], _MOST).astype(np.uint16).tobytes()))
            yield pd.DataFrame({"id": frame["id"], "class": frame["class"], "buckets": [f[0] for f in found], "counts": [f[1] for f in found]})

    picked = docs.select(F.col(id_col).alias("id"), F.col(class_col).cast("int").alias("class"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInPandas(scan, f"id {kind}, class int, buckets binary, counts binary")


def descend(samples: list[tuple[int, np.ndarray, np.ndarray]], visits: int = VISITS, rate: float = RATE, seed: int = SEED) -> Model:
    """The model learned from (class, buckets, counts) samples by stochastic gradient descent.

    Steps shrink with what a vector or the layer has moved already (Adagrad). Classes weigh as much
    as each other, so a score means the same whatever their shares of the sample.
    """
    rng = np.random.default_rng(seed)
    labels = np.array([s[0] for s in samples])
    ones = int(labels.sum())
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    layer, offset = np.zeros((DIM, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    moved, layer_moved = np.full(1 << BITS, 1e-10, dtype=np.float32), 1e-3
    balance = len(labels) / (2 * np.array([len(labels) - ones, ones]))
    epochs = max(1, round(visits / len(samples)))
    steps, step = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            label, buckets, counts = samples[i]
            now = rate * (1 - step / steps)
            step += 1
            if not len(buckets):
                continue
            share = (counts / counts.sum(dtype=np.int64)).astype(np.float32)
            hidden = share @ vectors[buckets]
            z = hidden @ layer + offset
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            p *= balance[label]
            back = layer @ p
            layer_moved += float(p @ p)
            pace = now / layer_moved**0.5
            layer -= np.outer(hidden, p) * pace
            offset -= p * pace
            moved[buckets] += share**2 * float(back @ back)
            vectors[buckets] -= np.outer(share / np.sqrt(moved[buckets]), back * now)
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(offset[1] - offset[0]))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str = "quality", sample_rows: int = SAMPLE_ROWS
) -> Model | None:
    """A model of the documents that ``labels`` marks 0 or 1; None if a class is missing.

    The sample is drawn from the labels, ``sample_rows`` of them at most, so its join to the
    documents broadcasts a table of proven size.
    """
    known = labels.select(F.col(id_col).alias("_label_id"), F.col(class_col).alias("_class")).where(F.col("_class").isin(0, 1))
    chosen = bounded_sample(known, "_label_id", "_class", sample_rows, SEED)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    pairs = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
    rows = sorted(document_features(pairs, "_id", "_text", "_class").collect(), key=lambda r: (r["id"], r["class"]))
    samples = [(r["class"], np.frombuffer(r["buckets"], dtype=np.uint16), np.frombuffer(r["counts"], dtype=np.uint16)) for r in rows]
    return descend(samples) if len({s[0] for s in samples}) == 2 else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of class 1 of each whole text."""
    names = [c for c in docs.columns if c != score_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    if model is None:
        return rows.withColumn(score_col, F.lit(1.0))
    place = names.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = model.scores(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=[*names, score_col])

    return rows.mapInArrow(scan, rows.withColumn(score_col, F.lit(1.0)).schema)
