"""Language identification by a string kernel: blended-spectrum n-gram presence, Nyström landmarks,
one-versus-rest kernel ridge regression.

The kernel of two texts is the number of distinct character n-grams, of every length from 1 to
``GRAMS``, that both contain, divided by the root of the product of their own numbers of distinct
n-grams. N-grams are compared by hash (``2**BITS`` values); only letters count, in lower case, with
runs of anything else as one separator. A bounded sample of labelled texts is drawn evenly from the
languages by id hash; some of them are the landmarks. With ``K`` the kernel between the sample and
the landmarks and ``M`` between the landmarks, the features of a text are ``k M^(-1/2)``, and one
ridge regression per language predicts 1 for its texts and -1 for the others.

A text's values are linear in its presence vector once that is scaled, so landmarks, whitening and
regressions fold into one matrix with a column per language, and a batch of texts is scored by one
matrix product with its presence matrix.

Results for odd input: a null text, or one without a letter, is ``und`` with score 0; texts of any
length are read in blocks; rows that repeat get equal results; rows with a null language are not
learned from; with no language to learn from every text is ``und``; with one, texts with letters
get that one. Ties go to the language that sorts first. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import bounded_sample, code_points, text_blocks

BITS = 15
GRAMS = 4
#: Labelled texts that the model is fitted on, at most, and how many of them are landmarks.
SAMPLE_ROWS = 2000
LANDMARKS = 300
RIDGE = 1e-2
SEED = 23
UNDETERMINED = "und"
#: Texts per presence matrix.
BATCH = 128

_SEPARATOR = 32


def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or the separator if it is no letter."""
    out = np.full(0x110000, _SEPARATOR, dtype=np.uint32)
    for c in range(0x110000):
        char = chr(c)
        if char.isalpha() or unicodedata.category(char)[0] == "M":  # marks belong to the letters they follow
            low = char.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def is_letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


class Presence:
    """Presence matrices of lists of texts. Built once on the driver and sent along with the job."""

    def __init__(self) -> None:
        self.table = letter_table()
        self.letters = is_letter_table()

    def matrix(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x 2**BITS) presence of hashed n-grams, and whether each text has a letter."""
        out = np.zeros((len(texts), 1 << BITS), dtype=bool)
        flat = out.reshape(-1)
        lettered = np.zeros(len(texts), dtype=bool)
        spread, shift = np.uint32(0x9E3779B1), np.uint32(32 - BITS)
        for rows, strings in text_blocks(texts, overlap=GRAMS):
            # Each string closes with a separator of its own, so that no n-gram depends on what follows it.
            raw, starts = code_points([s + " " for s in strings])
            lettered[rows[np.add.reduceat(self.letters[raw], starts, dtype=np.int64) > 0]] = True
            points = self.table[raw]
            gap = points == _SEPARATOR
            keep = np.ones(len(points), dtype=bool)
            np.logical_not(gap[1:] & gap[:-1], out=keep[1:])  # runs of separators count as one,
            keep[starts] = True  # but each string keeps the one that it begins with
            begin = np.concatenate(([0], np.cumsum(keep)))[starts]
            points = points[keep]
            ends = np.append(begin[1:], len(points))
            base = np.repeat((rows << BITS).astype(np.int32), ends - begin)
            h = np.zeros(len(points), dtype=np.uint32)
            for n in range(1, GRAMS + 1):
                size = len(points) - n + 1
                if size <= 0:
                    break
                h = h[:size] * np.uint32(0x01000193)
                h += points[n - 1 : n - 1 + size]
                h ^= np.uint32(n)
                at = ((h * spread) >> shift).astype(np.int32)
                at += base[:size]
                if n == 1:
                    first = at[begin]  # the separator, which every string has
                else:  # what would reach into the next string
                    over = (ends[:, None] - np.arange(1, n)[None, :]).ravel()
                    valid = (over >= np.repeat(begin, n - 1)) & (over < size)
                    at[over[valid]] = np.repeat(first, n - 1)[valid]
                flat[at] = True
        return out, lettered


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray  # float32, 2**BITS x languages


def lengths(presence: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(np.count_nonzero(presence, axis=1), 1)).astype(np.float32)[:, None]


def scaled(presence: np.ndarray) -> np.ndarray:
    """Presence vectors divided by their lengths, so that their products are kernel values."""
    return presence.astype(np.float32) / lengths(presence)


def regress(presence: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """The model of labelled presence vectors; None without any."""
    languages = sorted(set(langs))
    if not languages:
        return None
    # Landmarks in turn from each language, in the order of the sample.
    turn: dict[str, int] = {}
    rank = []
    for lang in langs:
        turn[lang] = turn.get(lang, 0) + 1
        rank.append(turn[lang])
    chosen = sorted(range(len(langs)), key=lambda i: (rank[i], langs[i]))[:landmarks]
    marks = scaled(presence[chosen])
    kernel = np.concatenate([scaled(presence[at : at + BATCH]) @ marks.T for at in range(0, len(langs), BATCH)]).astype(np.float64)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    solid = values > max(values.max(), 1e-12) * 1e-6
    whiten = vectors[:, solid] / np.sqrt(values[solid])
    z = kernel @ whiten
    target = np.where(np.array(langs)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Languages weigh alike, whatever their shares of the sample.
    weight = np.array([1.0 / turn[lang] for lang in langs])[:, None]
    w = np.linalg.solve(z.T @ (z * weight) + ridge * np.eye(z.shape[1]) / len(languages), z.T @ (target * weight))
    return Model(languages, (marks.T.astype(np.float64) @ (whiten @ w)).astype(np.float32))


def fit(presence: Presence, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model of the rows with a language. The driver gets ``sample_rows`` presence vectors at most, of ``2**BITS`` bits each."""
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                grams, _ = presence.matrix(part.column(1).to_pylist())
                bits = pa.array([row.tobytes() for row in np.packbits(grams, axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), bits, part.column(2)], names=["id", "bits", "lang"])

    rows = bounded_sample(known, "id", "lang", sample_rows, SEED).mapInArrow(scan, "id string, bits binary, lang string").collect()
    rows.sort(key=lambda r: (str(r["id"]), r["lang"], bytes(r["bits"])))
    if not rows:
        return None
    packed = np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), dtype=np.uint8).reshape(len(rows), -1)
    return regress(np.unpackbits(packed, axis=1).astype(bool), [r["lang"] for r in rows])


def identify(presence: Presence, docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row; the score is the winning regression's value on a 0 to 1 scale."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = None if model is None else model.matrix.astype(np.float64)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                grams, lettered = presence.matrix(part.column(1).to_pylist())
                if model is None:
                    best, score = np.full(part.num_rows, UNDETERMINED, dtype=object), np.zeros(part.num_rows)
                else:
                    # Double precision and rounding: a text's values don't depend on its place in the batch.
                    values = np.round((grams.astype(np.float64) @ weights) / lengths(grams), 9)
                    best = np.array(model.languages, dtype=object)[values.argmax(axis=1)]
                    score = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
                best = np.where(lettered, best, UNDETERMINED)
                score = np.where(lettered, score, 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.tolist(), pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])

    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = picked.mapInArrow(scan, f"id {picked.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
