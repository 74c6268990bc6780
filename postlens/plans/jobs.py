"""End-to-end batch jobs: files in, result store (or sorted text) out.

These are the composite jobs (C1, C2, C3, C5) as a user runs them. Each reads the posting files
once. Reports are keyed by the last name of each given path, whatever number of files it holds
(``source="file"``: by each file), and written as one run of the job into the result store. A
rerun with the same ``run`` replaces its own output; by default a run is new, and later runs win.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import schema
from postlens.functions.parse import gate
from postlens.operators import automaton, segment, skills, store
from postlens.plans import report
from postlens.sources.text import Paths, dictionary_name, keyword_dictionary, read_postings


def _write(spark: SparkSession, cells: DataFrame, store_path: str, job: str, run: int) -> DataFrame:
    store.write_cells(cells, store_path, job, run)
    return store.read_cells(spark, store_path, job, run)


def full_report_job(
    spark: SparkSession,
    path: Paths,
    store_path: str,
    dictionary_path: str | None = None,
    grid: Sequence[int] = schema.BATCH_GRID,
    run: int | None = None,
    source: str = "path",
    rebalance: bool = False,
) -> DataFrame:
    """Salary (both sides, and the cohort), keywords and the five dimensions of every report,
    as cells ``(row key, 'info', section, json)``. Returns the cells written."""
    run = store.new_run(spark, store_path) if run is None else run
    name = dictionary_name(dictionary_path)
    cells = report.report_cells_by_source(
        read_postings(spark, path, source=source, rebalance=rebalance),
        keyword_dictionary(spark, path=dictionary_path),
        version=run,
        dictionary_name=name,
        grid=grid,
    )
    return _write(spark, cells, store_path, "report", run)


def salary_job(
    spark: SparkSession,
    path: Paths,
    store_path: str,
    side: int = schema.CEILING,
    grid: Sequence[int] = schema.BATCH_GRID,
    run: int | None = None,
    source: str = "path",
    rebalance: bool = False,
) -> DataFrame:
    """``salary_<side>`` and ``salary3_<side>`` cells of every report."""
    run = store.new_run(spark, store_path) if run is None else run
    rows = report.salary_rows(read_postings(spark, path, source=source, rebalance=rebalance), side, grid, keep=("source",))
    counted = rows.groupBy("source", "qualifier", "key").agg(F.count(F.lit(1)).alias("n"))
    return _write(spark, report.json_cells(counted, F.col("source"), "qualifier", "key", run), store_path, f"salary_{side}", run)


def keyword_job(
    spark: SparkSession,
    path: Paths,
    store_path: str,
    dictionary_path: str | None = None,
    run: int | None = None,
    source: str = "path",
    rebalance: bool = False,
) -> DataFrame:
    """The ``skill_<dictionary name>`` cell of every report. A user's dictionary is searched with one
    automaton, whatever the kinds and lengths of its words; the bundled list by built-in functions."""
    run = store.new_run(spark, store_path) if run is None else run
    posts = gate(read_postings(spark, path, source=source, rebalance=rebalance), exact=schema.GATE_FULL)
    name = report.skill_section(dictionary_name(dictionary_path))
    counts = automaton.keyword_counts if dictionary_path else skills.keyword_counts
    counted = counts(posts, keyword_dictionary(spark, path=dictionary_path), by=("source",))
    cells = report.json_cells(counted.withColumn("qualifier", F.lit(name)), F.col("source"), "qualifier", "token", run)
    return _write(spark, cells, store_path, name, run)


def word_count_job(
    spark: SparkSession, path: str | list[str], out_path: str, sep: str = "\t", segmented: bool = False, dictionary_path: str | None = None
) -> None:
    """Words of field 10 of rows with more than 10 fields, stop words removed, written as
    ``(word,count)`` lines ordered by count.

    ``segmented`` cuts Han runs into words that are learned from the same texts, together with the
    words of the dictionary at ``dictionary_path``.
    """
    posts = gate(read_postings(spark, path, sep=sep), above=schema.GATE_WORD_COUNT_ABOVE)
    if segmented:
        own = keyword_dictionary(spark, path=dictionary_path) if dictionary_path else None
        counts = segment.word_counts(posts, "skills", schema.STOP_WORDS, own)
    else:
        counts = skills.word_counts(posts, "skills", schema.STOP_WORDS)
    report.save_word_count(counts, out_path)
