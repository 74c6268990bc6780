"""A corpus pipeline: documents in, packed token sequences out.

Each stage calls one operator of ``postlens.llm`` on all that the stage before it kept; what it
returns is written as Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``:

1. ``quality``: documents that the classifier predicts to be bad go;
2. ``exact_dedup``: of equal texts the row with the smallest id stays;
3. ``near_dedup``: of each class of near copies (5-word n-grams, Jaccard 0.8) one document stays;
4. ``mixing``: each document stays as often as the mix of sources takes it, 0 to 2 times;
5. ``packing``: the token ids of what is left, in sequences of at most 1024.

Odd input is handled as the operators say; empty documents give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import dedup, jaccard, mixing, packing, quality
from postlens.llm.common import cut, remainder, table
from postlens.llm.queries import QUALITY_FLOOR


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good, by a model of the labelled ones that are not held out."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    model = quality.fit(docs, labels)
    return quality.score(docs, model, score_col="_score").where(F.col("_score") >= QUALITY_FLOOR).drop("_score")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return dedup.exact_dedup(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.one_of_each_class(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): every piece with its ids and its place."""
    return packing.pack(packing.token_pieces(docs, packing.default_tokenizer()))


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", dissimilar_documents),
    ("mixing", mixed_documents),
    ("packing", packed_sequences),
]

#: The classifier and the packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
