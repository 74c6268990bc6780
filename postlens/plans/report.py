"""Composite jobs: the full batch report (C3), the salary (C1), keyword (C2) and word-count (C5) jobs.

The full report computes every section from ONE scan of the postings: each posting is exploded to
its ``(section, key)`` cells — salary buckets of both sides, the cohort buckets, the five
dimensions and the keyword tokens — and ONE aggregate counts them all (see ``plans/cells.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens import schema
from postlens.functions.jsonfmt import chunk_name, chunked, json_object
from postlens.functions.salary import bucket_hi, bucket_label, bucket_lo, keep_bucket, salary_part
from postlens.functions.text import keyword_tokens
from postlens.operators import store
from postlens.operators.skills import Needs, broadcastable, dictionary_needs
from postlens.plans.cells import explode_cells, keep_dictionary_counts, keep_dictionary_tokens, with_bucket_labels
from postlens.session import written


def skill_section(dictionary_name: str = schema.DEFAULT_DICTIONARY_NAME) -> str:
    return f"skill_{dictionary_name}"


def report_rows(
    postings: DataFrame,
    needs: Needs,
    dictionary_name: str = schema.DEFAULT_DICTIONARY_NAME,
    grid: Sequence[int] = schema.BATCH_GRID,
    cohort: tuple[str, str] = (schema.COHORT_EXPERIENCE, schema.COHORT_EDUCATION),
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep..., section, key`` — one row per cell of each posting (all keyword tokens, in the
    dictionary or not)."""
    full = F.col("n_fields") == schema.GATE_FULL
    ge10 = F.col("n_fields") >= schema.GATE_DIMENSIONS
    in_cohort = full & (F.col("experience") == cohort[0]) & (F.col("education") == cohort[1])
    dims = [d[0] for d in schema.DIMENSIONS if d[0] not in ("experience", "education")]
    carry = [*keep, "n_fields", "experience", "education", *dims, "_tok"]

    tokens = F.when(full, keyword_tokens("skills", needs)).alias("_tok")
    base = with_bucket_labels(postings.select(*carry[:-1], "salary", tokens), grid, False, carry)

    skill = skill_section(dictionary_name)
    fixed = [((f"salary_{s}",), F.when(full, F.col(f"_b{s}"))) for s in (0, 1)]
    fixed += [((f"salary3_{s}",), F.when(in_cohort, F.col(f"_b{s}"))) for s in (0, 1)]
    fixed += [((q,), F.when(ge10 & (F.col(c) != ""), F.col(c))) for c, q, _ in schema.DIMENSIONS]
    return explode_cells(base, ["section"], fixed, F.col("_tok"), (skill,), keep)


def full_report(
    postings: DataFrame,
    dictionary: DataFrame,
    dictionary_name: str = schema.DEFAULT_DICTIONARY_NAME,
    needs: Needs | None = None,
    keep: Sequence[str] = (),
    **kwargs,
) -> DataFrame:
    """``keep..., section, key, n`` — every section of the batch report from one scan and one
    aggregate. A dictionary that may be broadcast filters the tokens below the aggregate; a larger
    one meets the counted tokens above it."""
    needs = dictionary_needs(dictionary) if needs is None else needs
    rows = report_rows(postings, needs, dictionary_name, keep=keep, **kwargs)
    skill = skill_section(dictionary_name)
    columns = [*keep, "section", "key"]
    small = broadcastable(dictionary)
    if small:
        rows = keep_dictionary_tokens(rows, dictionary, "section", skill, columns, small)
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counted if small else keep_dictionary_counts(counted, dictionary, "section", skill, [*columns, "n"])


def json_cells(counted: DataFrame, row_key: str | Column, qualifier: str, key: str, version: int) -> DataFrame:
    """Cells ``(row_key, 'info', qualifier, json, version)`` of ``qualifier, key, n`` counts.

    A qualifier with more keys than a document holds has further cells ``<qualifier>#1``, ...
    (see :func:`chunked`), so a cell is bounded however many addresses or words there are. The counts are
    written first: the chunks need them twice, and the postings behind them are to be read once.
    """
    rk = F.lit(row_key) if isinstance(row_key, str) else row_key
    groups = ["_rk", "_q"]
    rows = written(counted.select(rk.alias("_rk"), F.col(qualifier).alias("_q"), F.col(key).alias("_k"), "n"), "report-counts")
    docs = chunked(rows, groups, "_k").groupBy(*groups, "chunk").agg(json_object("_k", "n").alias("value"))
    return store.as_cells(docs, "_rk", F.lit(schema.STORE_FAMILY), chunk_name(F.col("_q")), "value", F.lit(version))


def report_cells(report: DataFrame, row_key: str | Column, version: int = 0) -> DataFrame:
    """Cells of a report (``section, key, n``): one JSON object per section, in chunks if large."""
    return json_cells(report, row_key, "section", "key", version)


def report_cells_by_source(postings: DataFrame, dictionary: DataFrame, version: int = 0, **kwargs) -> DataFrame:
    """Cells of one report per row key (the ``source`` column), in one job for all of them."""
    return report_cells(full_report(postings, dictionary, keep=("source",), **kwargs), F.col("source"), version)


def salary_rows(
    postings: DataFrame, side: int = schema.CEILING, grid: Sequence[int] = schema.BATCH_GRID, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep..., qualifier, key`` — the salary job's cells of each posting: ``salary_<side>``
    for rows with 11 fields and ``salary3_<side>`` for the cohort among them."""
    start, end, step = grid
    full = F.col("n_fields") == schema.GATE_FULL
    in_cohort = (
        full
        & (F.col("experience") == schema.COHORT_EXPERIENCE)
        & (F.col("education") == schema.COHORT_EDUCATION)
    )
    v = postings.where(full).select(*keep, in_cohort.alias("_c"), salary_part("salary", side).alias("_v"))
    lo = v.select(*keep, "_c", bucket_lo(F.col("_v"), start, end, step).alias("lo"))
    b = lo.select(*keep, "_c", "lo", bucket_hi(F.col("lo"), end, step).alias("hi"))
    label = F.when(keep_bucket(F.col("lo"), F.col("hi"), False), bucket_label(F.col("lo"), F.col("hi")))
    b = b.select(*keep, "_c", label.alias("key"))
    entries = F.array(
        F.struct(F.lit(f"salary_{side}").alias("qualifier"), F.col("key").alias("key")),
        F.struct(F.lit(f"salary3_{side}").alias("qualifier"), F.when(F.col("_c"), F.col("key")).alias("key")),
    )
    return b.select(*keep, F.inline(entries)).where(F.col("key").isNotNull())


def salary_report(postings: DataFrame, side: int = schema.CEILING, grid: Sequence[int] = schema.BATCH_GRID) -> DataFrame:
    """``qualifier, key, n`` — the two cells of the salary job (C1), from one aggregate."""
    return salary_rows(postings, side, grid).groupBy("qualifier", "key").agg(F.count(F.lit(1)).alias("n"))


def save_word_count(ranked: DataFrame, path: str, fmt: str = "text") -> None:
    """Writes ``(token,n)`` lines ordered by count (S4). The sort is a distributed range sort;
    ``fmt='text'`` writes ``(token,n)`` lines, other formats write the columns."""
    ordered = ranked.orderBy(F.col("n").desc(), F.col("token").asc())
    if fmt == "text":
        ordered.select(F.format_string("(%s,%d)", "token", "n").alias("value")).write.mode("overwrite").text(path)
    else:
        ordered.write.mode("overwrite").format(fmt).save(path)
