"""Exact deduplication by content sort (DataFrame operations only).

The normalised texts are range-partitioned by sampled splitters (on the first characters and a
hash of the whole text, so that the sample stays small), sorted externally within their range, and
a window over that sort compares each row's whole text with its neighbour's: a run of equal
neighbours is a group, whose smallest identifier stays.

A text whose copies hold more than a quarter of an average partition would make its range too
large. Such texts are found beforehand from 8-byte hashes (sizes summed before the shuffle; there
are at most ``4 x partitions`` of them, so they may be broadcast) and their rows get a salt that
is part of the sort key. The runs of one text under different salts are then joined by their
whole text, one row per run.

Results for odd input: a null text counts as empty; empty texts are equal to each other. A null
id sorts after all others and stays only if its group has no other. Rows that repeat with the
same id are copies: one of them stays. An empty table gives an empty result. Columns of the input
may have any name; those that the operator adds replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import SPACE_CLASS, cut, shuffle_partitions, text_or_empty

ADDED = ("keep_id", "group_size", "kept", "text_sha256")
#: Characters of a text that its range key holds, before a hash of the whole text.
PREFIX_CHARS = 64
#: A text is hot when its copies hold more than 1 / (HOT_SHARE x partitions) of all bytes.
HOT_SHARE = 4


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), f"{SPACE_CLASS}+", " ")


def hot_texts(docs: DataFrame, text_col: str, partitions: int) -> DataFrame:
    """(hash, pieces) of the texts whose copies together exceed the share; at most HOT_SHARE x partitions rows."""
    total = docs.agg(F.sum(F.octet_length(text_or_empty(text_col)) + 32)).first()[0] or 0
    share = max(1.0, total / (HOT_SHARE * partitions))
    norm = normalised(text_col)
    return (
        docs.select(F.xxhash64(norm).alias("_hash"), (F.octet_length(norm) + 32).alias("_bytes"))
        .groupBy("_hash")
        .agg(F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) & (F.col("_bytes") > share))
        .select("_hash", F.ceil(F.col("_bytes") / share).cast("long").alias("_pieces"))
    )


def _marked(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_row`` (the carried columns) and the added columns."""
    partitions = shuffle_partitions(docs.sparkSession)
    # Own names inside, so that no input column can clash.
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        normalised(text_col).alias("_norm"),
        F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]).alias("_row") if carry else F.lit(None).cast("int").alias("_row"),
    )
    hot = cut(hot_texts(docs, text_col, partitions), "dedup-hot")
    salted = rows.withColumn("_hash", F.xxhash64("_norm")).join(F.broadcast(hot), "_hash", "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64("_id", F.lit(5)), F.col("_pieces")), F.lit(0))
    )
    # The splitters are sampled from keys of bounded size, as they pass through the driver.
    ranged = salted.withColumn("_prefix", F.substring("_norm", 1, PREFIX_CHARS)).repartitionByRange(partitions, "_prefix", "_hash", "_salt")
    run = Window.partitionBy("_prefix", "_hash", "_salt", "_norm")
    runs = ranged.select(
        "*",
        F.row_number().over(run.orderBy(F.col("_id").asc_nulls_last())).alias("_rank"),
        F.min("_id").over(run).alias("_min"),
        F.count(F.lit(1)).over(run).alias("_size"),
    ).select(
        "_id",
        "_row",
        "_rank",
        "_min",
        "_size",
        F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"),
        # One row of each salted run keeps the text, for the comparison between runs.
        F.when(F.col("_pieces").isNotNull() & (F.col("_rank") == 1), F.col("_norm")).alias("_head"),
    )
    runs = cut(runs, "dedup-runs")
    whole = (
        runs.where(F.col("_head").isNotNull())
        .groupBy("_head")
        .agg(F.first("_sha").alias("_sha"), F.min("_min").alias("_whole_min"), F.sum("_size").alias("_whole_size"))
        .drop("_head")
    )
    merged = runs.drop("_head").join(F.broadcast(whole), "_sha", "left")
    keep = F.coalesce("_whole_min", "_min")
    return merged.select(
        "_id",
        "_row",
        keep.alias("keep_id"),
        F.coalesce("_whole_size", "_size").cast("long").alias("group_size"),
        # Rows with the same id are in one run, of which the first row stays.
        ((F.col("_rank") == 1) & F.col("_id").eqNullSafe(keep)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``carry=False`` returns the id and the added columns alone and shuffles the normalised texts
    only.
    """
    if not carry:
        return _marked(docs, id_col, text_col, []).select(F.col("_id").alias(id_col), *ADDED)
    names = [c for c in docs.columns if c not in ADDED]
    return _marked(docs, id_col, text_col, names).select(*[F.col("_row")[c].alias(c) for c in names], *ADDED)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    kept = _marked(docs, id_col, text_col, docs.columns).where("kept")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
