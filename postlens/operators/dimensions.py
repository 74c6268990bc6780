"""Categorical dimension counts (A4-A8), labels (P12), per-dimension JSON (A12) and ranks (L2).

The five dimensions are unpivoted to ``(dim, value)`` rows and counted by ONE aggregate: one
shuffle for all five instead of one per dimension. Partial aggregation on the map side leaves at
most one row per (dim, value) per task, so a hot value (one address holding a third of all rows)
shrinks to a single row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens import schema
from postlens.functions.jsonfmt import chunk_name, chunked, json_object
from postlens.operators.rank import row_number_within

Dim = tuple[str, str, str]  # (column, qualifier, label)


def dimension_entries(dims: Sequence[Dim] = schema.DIMENSIONS, use: str = "qualifier") -> Column:
    """``ARRAY<STRUCT<dim, value>>`` of a posting's dimension cells (``dim`` = qualifier or label)."""
    pick = 1 if use == "qualifier" else 2
    return F.array(*[F.struct(F.lit(d[pick]).alias("dim"), F.col(d[0]).alias("value")) for d in dims])


def unpivot(postings: DataFrame, dims: Sequence[Dim] = schema.DIMENSIONS, use: str = "qualifier") -> DataFrame:
    """``dim, value`` rows of non-empty dimension cells (empty text means missing)."""
    return (
        postings.select(F.inline(dimension_entries(dims, use)))
        .where(F.col("value").isNotNull() & (F.col("value") != ""))
    )


def counts(postings: DataFrame, dims: Sequence[Dim] = schema.DIMENSIONS, use: str = "qualifier") -> DataFrame:
    """``dim, value, n`` for every non-empty value of each dimension."""
    return unpivot(postings, dims, use).groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"))


def labelled_counts(postings: DataFrame) -> DataFrame:
    """``label, value, n`` — counts under the display labels (地址, 公司类型, ...)."""
    return counts(postings, use="label").withColumnRenamed("dim", "label")


def ranked(dim_counts: DataFrame) -> DataFrame:
    """``dim, value, n, rnk`` — 1 = most frequent value of its dimension (ties by value)."""
    return row_number_within(dim_counts, ["dim"], [F.col("n").desc(), F.col("value").asc()])


def as_json(dim_counts: DataFrame, key: str = "dim") -> DataFrame:
    """``<key>, json`` — one JSON object ``{value: n}`` per dimension, in chunks (``<key>#1``, ...)
    where a dimension has more values than a document holds."""
    docs = chunked(dim_counts, [key], "value").groupBy(key, "chunk").agg(json_object("value", "n").alias("json"))
    return docs.select(chunk_name(F.col(key)).alias(key), "json")


def write_by_dimension(dim_counts: DataFrame, path: str) -> None:
    """Writes ``(dim, value, n)`` rows with one folder per dimension (the custom partitioner, U4).

    The partitioner becomes the layout of the output: a reader of one dimension reads its folder
    only. Rows keep the partitions of their aggregate, so no dimension is gathered into one task.
    """
    dim_counts.write.mode("overwrite").partitionBy("dim").parquet(path)
