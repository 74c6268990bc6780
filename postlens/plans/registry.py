"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.

Posting queries read the posting lines Spark derives from ``orders ⋈ customer ⋈ nation`` (one per
order); the result-store queries read ``events``; the document word count reads ``documents``.
Queries that exercise a file source or sink first write the derived lines / cells to a fresh
folder under the shared checkpoint directory, with the partitions they have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import fs, schema
from postlens.functions.parse import gate, postings
from postlens.operators import automaton, dimensions, frequent, intervals, pairs, salary, segment, skills, store
from postlens.plans import jobs, report
from postlens.session import scratch_path
from postlens.sources.fixture import posting_lines, table
from postlens.sources.text import keyword_dictionary, stream_lines, write_lines
from postlens.streaming import report as stream_report

Query = Callable[[SparkSession, str], DataFrame]

# Edges of the arbitrary-edge histogram (a user parameter of J2).
EDGES = [0, 2000, 3000, 4500, 6000, 8000, 10000, 15000, 20000, 30000, 50000]


def fixture_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(posting_lines(spark, sf_dir), "line", id_col="id")


def full_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate(fixture_postings(spark, sf_dir), exact=schema.GATE_FULL)


def q_postings_parse(spark, sf_dir):
    return fixture_postings(spark, sf_dir)


def q_field_count_gates(spark, sf_dir):
    n = F.col("n_fields")
    counts = fixture_postings(spark, sf_dir).agg(
        F.count_if(n >= schema.GATE_STREAM_SALARY).alias("ge5"),
        F.count_if(n >= schema.GATE_DIMENSIONS).alias("ge10"),
        F.count_if(n == schema.GATE_FULL).alias("eq11"),
        F.count_if(n > schema.GATE_WORD_COUNT_ABOVE).alias("gt10"),
        F.count(F.lit(1)).alias("all"),
    )
    return counts.unpivot([], ["ge5", "ge10", "eq11", "gt10", "all"], "gate", "n")


def q_salary_bucket_assign(spark, sf_dir):
    return salary.assign_buckets(fixture_postings(spark, sf_dir), schema.STREAM_GRID)


def q_salary_histogram_ceil(spark, sf_dir):
    return salary.histogram(full_postings(spark, sf_dir), schema.CEILING, schema.BATCH_GRID)


def q_salary_histogram_floor(spark, sf_dir):
    return salary.histogram(full_postings(spark, sf_dir), schema.FLOOR, schema.BATCH_GRID)


def q_salary_cohort_histogram(spark, sf_dir):
    return salary.two_sided_histogram(salary.cohort(full_postings(spark, sf_dir)), schema.BATCH_GRID)


def q_salary_histogram_edges(spark, sf_dir):
    return salary.edge_histogram(full_postings(spark, sf_dir), EDGES, schema.CEILING)


def q_salary_bucket_range_join(spark, sf_dir):
    """Ceiling salaries counted in the intervals of a table: one per supplier, of every width, overlapping."""
    balance = F.abs(F.floor("s_acctbal")).cast("bigint")
    wanted = table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_acctbal"]).select("s_name", balance.alias("lo"), (balance + F.col("s_suppkey") * 37 % 5000).alias("hi"))
    values = full_postings(spark, sf_dir).select(salary.salary_part("salary", schema.CEILING).alias("ceiling"))
    return intervals.interval_counts(values, wanted, "ceiling", ["s_name"])


def q_salary_grid(spark, sf_dir):
    """Every bucket of a grid that reaches beyond all salaries, empty ones too."""
    return salary.full_grid_histogram(full_postings(spark, sf_dir), schema.FLOOR, (0, 90000, 7000))


def q_salary_report(spark, sf_dir):
    return report.salary_report(fixture_postings(spark, sf_dir), schema.CEILING, schema.BATCH_GRID)


def dimension_postings(spark, sf_dir):
    return gate(fixture_postings(spark, sf_dir), min_fields=schema.GATE_DIMENSIONS)


def q_dimension_counts(spark, sf_dir):
    return dimensions.counts(dimension_postings(spark, sf_dir))


def q_dimension_labels(spark, sf_dir):
    return dimensions.labelled_counts(dimension_postings(spark, sf_dir))


def q_dimension_json(spark, sf_dir):
    return dimensions.as_json(dimensions.counts(dimension_postings(spark, sf_dir)))


def q_dimension_rank(spark, sf_dir):
    return dimensions.ranked(dimensions.counts(dimension_postings(spark, sf_dir)))


def q_skill_keyword_count(spark, sf_dir):
    return skills.keyword_counts(full_postings(spark, sf_dir), keyword_dictionary(spark))


def q_skills_word_count(spark, sf_dir):
    rows = gate(fixture_postings(spark, sf_dir), above=schema.GATE_WORD_COUNT_ABOVE)
    return skills.ranked_word_counts(skills.word_counts(rows, "skills", schema.STOP_WORDS))


def q_document_word_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["text"])
    return skills.ranked_word_counts(skills.word_counts(docs, "text", schema.STOP_WORDS))


def q_full_report(spark, sf_dir):
    return report.full_report(fixture_postings(spark, sf_dir), keyword_dictionary(spark))


def q_full_report_cells(spark, sf_dir):
    rep = report.full_report(fixture_postings(spark, sf_dir), keyword_dictionary(spark))
    return report.report_cells(rep, "postings")


CELL_VALUE = ["row_key", "family", "qualifier", "value"]


def q_source_file_key(spark, sf_dir):
    """One report per given path: the lines are written into a folder per remainder of the order
    key, and the full report job is given those folders, whose names are the row keys."""
    base = write_lines(posting_lines(spark, sf_dir), scratch_path(spark, "postings-text"), by=F.col("id") % 3)
    folders = [f"{base}/{n}" for n in fs.children(spark, base) if n.startswith("part=")]
    return jobs.full_report_job(spark, folders, scratch_path(spark, "report-cells")).select(*CELL_VALUE)


def q_job_cells(spark, sf_dir):
    """The salary job (both sides), the keyword job and the full report job on one store, the full
    report first: the newest value of every cell that any of them wrote."""
    path = {"postings": write_lines(posting_lines(spark, sf_dir), scratch_path(spark, "postings-text"))}
    cells = scratch_path(spark, "job-cells")
    jobs.full_report_job(spark, path, cells)
    jobs.salary_job(spark, path, cells, side=schema.CEILING)
    jobs.salary_job(spark, path, cells, side=schema.FLOOR)
    jobs.keyword_job(spark, path, cells)
    return store.latest(store.read_cells(spark, cells)).select(*CELL_VALUE)


def q_tab_word_count(spark, sf_dir):
    """The word-count job from tab-separated lines to sorted text, read back."""
    tabbed = posting_lines(spark, sf_dir).select(F.translate("line", "|", "\t").alias("line"))
    out = scratch_path(spark, "word-count")
    jobs.word_count_job(spark, write_lines(tabbed, scratch_path(spark, "postings-tab")), out)
    line = spark.read.text(out)
    return line.select(F.regexp_extract("value", r"^\((.*),\d+\)$", 1).alias("token"), F.regexp_extract("value", r",(\d+)\)$", 1).cast("bigint").alias("n"))


#: A user dictionary with words of every rule: ASCII, Han, mixed script, symbols and spaces.
USER_WORDS = ["Spark", "java", "mysql", "算法", "数据挖掘", "据挖", "及linux", "算法及linux", "Need spark", "need java", "the!!", "of%%%", "of the", "in###", "*** the&&&"]


def q_user_dictionary_count(spark, sf_dir):
    """Keyword counts of a user's dictionary file over the postings' skills and all documents."""
    path = scratch_path(spark, "dictionary") + "/user.dic"
    spark.createDataFrame([(w,) for w in USER_WORDS], "value string").write.text(path)
    texts = full_postings(spark, sf_dir).select("skills").unionByName(table(spark, sf_dir, "documents", ["text"]).select(F.col("text").alias("skills")))
    return automaton.keyword_counts(texts, keyword_dictionary(spark, path=path))


def q_document_term_count(spark, sf_dir):
    """Counts in the documents of a dictionary that the data give: the distinct ASCII words of
    the benchmark passages and market segments, of every length, written as a dictionary file."""
    path = scratch_path(spark, "dictionary") + "/names.dic"
    names = table(spark, sf_dir, "benchmark", ["text"]).select(F.col("text").alias("name"))
    names = names.unionByName(table(spark, sf_dir, "customer", ["c_mktsegment"]).toDF("name"))
    words = names.select(F.explode(F.regexp_extract_all(F.lower("name"), F.lit("[a-z]+"), F.lit(0))).alias("value")).distinct()
    words.write.text(path)
    docs = table(spark, sf_dir, "documents", ["text"])
    return automaton.keyword_counts(docs, keyword_dictionary(spark, path=path), "text")


#: Han characters that stand for the letters a to z, so that the documents become text without spaces.
HAN_LETTERS = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def han_texts(spark, sf_dir) -> DataFrame:
    """The postings' skills, and all documents with their letters as Han characters and no spaces: runs
    as long as a sentence."""
    docs = table(spark, sf_dir, "documents", ["text"])
    return full_postings(spark, sf_dir).select("skills").unionByName(docs.select(F.translate(F.lower("text"), LETTERS + " ", HAN_LETTERS).alias("skills")))


def q_han_word_statistics(spark, sf_dir):
    """Occurrences, cohesion and neighbour entropies of the word candidates of Han text."""
    runs = segment.counted_runs(skills.word_counts(han_texts(spark, sf_dir), "skills")).transform(stored_once)
    total = segment.characters(runs).first()["total"]
    return segment.word_statistics(segment.ngram_counts(runs, segment.LONGEST + 1).transform(stored_once), total)


def q_han_word_count(spark, sf_dir):
    """Word count of Han text: words learned from the text, and those of a user's dictionary."""
    return segment.word_counts(han_texts(spark, sf_dir), "skills", schema.STOP_WORDS, keyword_dictionary(spark, words=USER_WORDS))


def stored_once(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "stored")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_dimension_files(spark, sf_dir):
    """Dimension counts written with a folder per dimension, read back."""
    path = scratch_path(spark, "dimension-files")
    dimensions.write_by_dimension(dimensions.counts(dimension_postings(spark, sf_dir)), path)
    return spark.read.schema("value string, n bigint, dim string").parquet(path).select("dim", "value", "n")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def event_cells(spark, sf_dir):
    ev = table(spark, sf_dir, "events", ["user_id", "event_type", "props", "event_id"])
    return store.as_cells(ev, F.col("user_id"), F.lit(schema.STORE_FAMILY), "event_type", "props", "event_id")


def stored_event_cells(spark, sf_dir):
    """All events written to a result store as one run, then read back."""
    path = scratch_path(spark, "cell-store")
    store.write_cells(event_cells(spark, sf_dir), path, "events", 0)
    return store.read_cells(spark, path)


def q_cell_store_latest(spark, sf_dir):
    return store.latest(stored_event_cells(spark, sf_dir))


def q_cell_store_pivot(spark, sf_dir):
    return store.pivot(stored_event_cells(spark, sf_dir), EVENT_TYPES, schema.STORE_FAMILY)


def q_cell_store_text(spark, sf_dir):
    return store.as_text(store.latest(stored_event_cells(spark, sf_dir)), schema.STORE_FAMILY).select("row_key", "text")


STORE_RUNS = 30


def compacted_store(spark, sf_dir) -> str:
    """All events written as ``STORE_RUNS`` runs, by the remainder of the event's id; compacted after
    two thirds of them and again at the end but for the last run."""
    path, cells = scratch_path(spark, "cell-store"), stored_once(event_cells(spark, sf_dir))
    for k in range(STORE_RUNS):
        run = store.new_run(spark, path)
        store.write_cells(cells.where(F.col("version") % STORE_RUNS == k), path, "events", run)
        if k in (STORE_RUNS * 2 // 3, STORE_RUNS - 2):
            store.compact(spark, path)
    store.vacuum(spark, path)
    return path


def q_cell_store_compacted(spark, sf_dir):
    """The newest cells of a store whose runs were compacted twice while it was written."""
    return store.latest(store.read_cells(spark, compacted_store(spark, sf_dir)))


def q_cell_store_scan(spark, sf_dir):
    """The newest cells of a range of row keys and of those with a prefix, read from a compacted store."""
    cells = store.read_cells(spark, compacted_store(spark, sf_dir))
    between = store.latest(store.rows_between(cells, "2", "37")).withColumn("scan", F.lit("range"))
    return between.unionByName(store.latest(store.rows_with_prefix(cells, "19")).withColumn("scan", F.lit("prefix")))


def q_result_store_keys(spark, sf_dir):
    """Keys of the store that match a pattern: one character, then a 1, then anything."""
    return store.keys(stored_event_cells(spark, sf_dir), "?1*")


def q_common_owner_lookup(spark, sf_dir):
    """Orders holding both a part and a supplier, for every (part, supplier) that was ordered.

    The index ``(member, order)`` comes straight from ``lineitem`` rows, so no order's items are
    gathered into one row. Members are numbers, parts even and suppliers odd. The requested pairs
    are all distinct (part, supplier) combinations of ``lineitem``; hot members are salted.
    """
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"])
    part, supplier = F.col("l_partkey").cast("bigint") * 2, F.col("l_suppkey").cast("bigint") * 2 + 1
    index = li.select(F.explode(F.array(part, supplier)).alias("member"), F.col("l_orderkey").alias("owner")).distinct()
    wanted = li.select(part.alias("a"), supplier.alias("b")).distinct()
    rows = pairs.owners_for_pairs(index, wanted, ordered=False, salt=4)
    return rows.select(F.shiftright("a", 1).alias("part"), F.shiftright("b", 1).alias("supplier"), F.col("owner").alias("l_orderkey"))


def q_common_members(spark, sf_dir):
    """Member lists as text, one per order: which orders list a market segment before a status.

    The lists are ``<order> <segment> <priority words> <status>``; the pairs asked for are all
    segments with all statuses.
    """
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"])
    customer = table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    lists = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat_ws(" ", F.col("o_orderkey").cast("string"), "c_mktsegment", "o_orderpriority", "o_orderstatus").alias("value")
    )
    wanted = customer.join(orders, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("a"), F.col("o_orderstatus").alias("b")).distinct()
    return pairs.common_owner_rows(pairs.member_lists(lists), wanted, ordered=True, salt=4)


#: Least numbers of lists of the two queries of frequent pairs.
SUPPLIER_SUPPORT, PART_SUPPORT = 40, 2


def q_frequent_supplier_pairs(spark, sf_dir):
    """Pairs of suppliers that at least ``SUPPLIER_SUPPORT`` customers both bought from: long lists of members."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey"])
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    index = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").cast("bigint").alias("member"), F.col("o_custkey").alias("owner"))
    return frequent.frequent_pairs(index, SUPPLIER_SUPPORT)


def q_co_purchased_parts(spark, sf_dir):
    """Pairs of parts that at least ``PART_SUPPORT`` orders hold both: short lists, most pairs in one only."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    index = li.select(F.col("l_partkey").cast("bigint").alias("member"), F.col("l_orderkey").alias("owner"))
    return frequent.frequent_pairs(index, PART_SUPPORT)


STREAM_BATCHES = 3
STREAM_JOB = "job"


def drain(spark, folder: str, store_path: str, checkpoint: str, metrics=stream_report.ALL_METRICS, **kwargs) -> None:
    """Runs the streaming report over the text files of a folder until they are all read, in
    about ``STREAM_BATCHES`` micro-batches however many files there are."""
    files = sum(1 for n in fs.children(spark, folder) if n.startswith("part-"))
    lines = stream_lines(spark, "files", {"maxFilesPerTrigger": str(max(1, -(-files // STREAM_BATCHES)))}, path=folder)
    query = stream_report.start(
        spark, lines, keyword_dictionary(spark), store_path, checkpoint,
        trigger={"availableNow": True}, metrics=metrics,
        state_partitions=spark.sparkContext.defaultParallelism, **kwargs,
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_stream(spark, sf_dir, metrics=stream_report.ALL_METRICS) -> DataFrame:
    """Posting lines written as text, drained by the streaming report, then the running totals
    read from its result store."""
    folder = write_lines(posting_lines(spark, sf_dir), scratch_path(spark, "stream-input"))
    store_path = scratch_path(spark, "stream-store")
    drain(spark, folder, store_path, scratch_path(spark, "stream-ckpt"), metrics)
    return stream_report.totals(spark, store_path)


def q_stream_restart(spark, sf_dir):
    """A stream that stops after half of the postings and resumes on its checkpoint with the rest,
    into a store that an earlier query had already filled."""
    lines, folder = posting_lines(spark, sf_dir), scratch_path(spark, "stream-input")
    store_path, checkpoint = scratch_path(spark, "stream-store"), scratch_path(spark, "stream-ckpt")
    even = lines.where(F.col("id") % 2 == 0).select(F.col("line").alias("value"))
    odd = lines.where(F.col("id") % 2 != 0).select(F.col("line").alias("value"))
    even.write.mode("append").text(folder)
    drain(spark, folder, store_path, scratch_path(spark, "stream-ckpt"))  # an earlier life of the store
    drain(spark, folder, store_path, checkpoint)
    odd.write.mode("append").text(folder)
    drain(spark, folder, store_path, checkpoint)
    return stream_report.totals(spark, store_path)


def q_stream_state_rebuild(spark, sf_dir):
    """A store rebuilt from the state in the stream's checkpoint after the stream's own is lost."""
    folder = write_lines(posting_lines(spark, sf_dir), scratch_path(spark, "stream-input"))
    store_path, checkpoint = scratch_path(spark, "stream-store"), scratch_path(spark, "stream-ckpt")
    drain(spark, folder, store_path, checkpoint)
    fs.delete(spark, store_path)
    stream_report.rebuild(spark, checkpoint, store_path)
    return stream_report.totals(spark, store_path)


def q_stream_documents_read(spark, sf_dir):
    """The totals read back from the stream's JSON documents."""
    return stream_report.read_documents(stream_report.json_documents(run_stream(spark, sf_dir), STREAM_JOB))


def q_stream_json_store(spark, sf_dir):
    """The documents that the stream's own per-batch writer left, newest first."""
    folder = write_lines(posting_lines(spark, sf_dir), scratch_path(spark, "stream-input"))
    json_store = scratch_path(spark, "stream-json")
    drain(spark, folder, scratch_path(spark, "stream-store"), scratch_path(spark, "stream-ckpt"), json_store=json_store, job=STREAM_JOB)
    return stream_report.stored(spark, json_store).select(F.col("row_key").alias("key"), "value")


def q_stream_json_incremental(spark, sf_dir):
    """The documents kept up in update mode: each batch reads and writes those that its cells change."""
    folder = write_lines(posting_lines(spark, sf_dir), scratch_path(spark, "stream-input"))
    json_store = scratch_path(spark, "stream-json")
    drain(spark, folder, scratch_path(spark, "stream-store"), scratch_path(spark, "stream-ckpt"), json_store=json_store, job=STREAM_JOB, output_mode="update")
    return stream_report.stored_documents(spark, json_store)


def q_stream_salary_floor(spark, sf_dir):
    return run_stream(spark, sf_dir, [stream_report.SALARY_FLOOR])


def q_stream_salary_ceil(spark, sf_dir):
    return run_stream(spark, sf_dir, [stream_report.SALARY_CEILING])


def q_stream_skill_counts(spark, sf_dir):
    return run_stream(spark, sf_dir, [stream_report.SKILLS])


def q_stream_dimension_counts(spark, sf_dir):
    return run_stream(spark, sf_dir, [stream_report.OTHER])


def q_stream_report(spark, sf_dir):
    return run_stream(spark, sf_dir)


def q_stream_report_json(spark, sf_dir):
    return stream_report.json_documents(run_stream(spark, sf_dir), STREAM_JOB)


def registered() -> dict[str, Query]:
    return {
        "postings_parse": q_postings_parse,
        "field_count_gates": q_field_count_gates,
        "salary_bucket_assign": q_salary_bucket_assign,
        "salary_histogram_ceil": q_salary_histogram_ceil,
        "salary_histogram_floor": q_salary_histogram_floor,
        "salary_cohort_histogram": q_salary_cohort_histogram,
        "salary_histogram_edges": q_salary_histogram_edges,
        "salary_bucket_range_join": q_salary_bucket_range_join,
        "salary_grid": q_salary_grid,
        "salary_report": q_salary_report,
        "dimension_counts": q_dimension_counts,
        "dimension_labels": q_dimension_labels,
        "dimension_json": q_dimension_json,
        "dimension_rank": q_dimension_rank,
        "skill_keyword_count": q_skill_keyword_count,
        "skills_word_count": q_skills_word_count,
        "document_word_count": q_document_word_count,
        "full_report": q_full_report,
        "full_report_cells": q_full_report_cells,
        "source_file_key": q_source_file_key,
        "job_cells": q_job_cells,
        "tab_word_count": q_tab_word_count,
        "user_dictionary_count": q_user_dictionary_count,
        "document_term_count": q_document_term_count,
        "han_word_statistics": q_han_word_statistics,
        "han_word_count": q_han_word_count,
        "dimension_files": q_dimension_files,
        "cell_store_latest": q_cell_store_latest,
        "cell_store_pivot": q_cell_store_pivot,
        "cell_store_text": q_cell_store_text,
        "cell_store_compacted": q_cell_store_compacted,
        "cell_store_scan": q_cell_store_scan,
        "result_store_keys": q_result_store_keys,
        "common_owner_lookup": q_common_owner_lookup,
        "common_members": q_common_members,
        "frequent_supplier_pairs": q_frequent_supplier_pairs,
        "co_purchased_parts": q_co_purchased_parts,
        "stream_salary_floor": q_stream_salary_floor,
        "stream_salary_ceil": q_stream_salary_ceil,
        "stream_skill_counts": q_stream_skill_counts,
        "stream_dimension_counts": q_stream_dimension_counts,
        "stream_report": q_stream_report,
        "stream_report_json": q_stream_report_json,
        "stream_state_rebuild": q_stream_state_rebuild,
        "stream_documents_read": q_stream_documents_read,
        "stream_json_store": q_stream_json_store,
        "stream_json_incremental": q_stream_json_incremental,
        "stream_restart": q_stream_restart,
    }
