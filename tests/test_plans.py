"""Plan properties of every registered query: no Python evaluation, no cross join, pruned scans.

Queries that run jobs of their own while they are built (stores, jobs, rank checkpoints) are held to
the same rules: the plan of every frame that is written or checkpointed on the way is kept too.
"""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

from postlens.operators import store
from postlens.plans import registry, report
from postlens.plans.cells import keep_dictionary_counts, keep_dictionary_tokens
from postlens.sources.text import keyword_dictionary
from tests.conftest import SF_SMALL

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """Texts of the plans of all frames written or checkpointed during the test."""
    seen = []

    def kept(owner, name, frame):
        before = getattr(owner, name)

        def call(self, *args, **kwargs):
            if not frame(self).isStreaming:
                seen.append(executed(frame(self)))
            return before(self, *args, **kwargs)

        monkeypatch.setattr(owner, name, call)

    for name in ("parquet", "text"):
        kept(DataFrameWriter, name, lambda writer: writer._df)
    kept(DataFrame, "checkpoint", lambda df: df)
    return seen


@pytest.mark.parametrize("name", sorted(registry.registered()))
def test_no_python_and_pruned_scans(spark, plans, name):
    df = registry.registered()[name](spark, SF_SMALL)
    df.collect()
    for plan in [*plans, executed(df)]:
        for node in PYTHON_NODES:
            assert node not in plan, (name, node)
        for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "RoundRobinPartitioning"):
            assert node not in plan, (name, node)
        # Scans of the wide driver tables read only the columns the query needs.
        for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
            assert "o_comment" not in schema and "l_comment" not in schema and "c_address" not in schema, name
            assert "o_orderdate" not in schema and "ts:" not in schema, (name, schema)


def test_streaming_plan(spark):
    """The plan of the micro-batches themselves: native, one stateful aggregate, no cross join."""
    folder = registry.write_lines(registry.posting_lines(spark, SF_SMALL), registry.scratch_path(spark, "plan-stream"))
    query = registry.stream_report.start(
        spark, registry.stream_lines(spark, "files", {}, path=folder), keyword_dictionary(spark),
        registry.scratch_path(spark, "plan-store"), registry.scratch_path(spark, "plan-ckpt"), trigger={"availableNow": True},
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.count("StateStoreSave") == 1 and "FileScan text" in plan
    assert not any(node in plan for node in (*PYTHON_NODES, "BroadcastNestedLoopJoin", "CartesianProduct"))


def test_documents_scan_reads_text_only(spark):
    from postlens import schema
    from postlens.operators import skills
    from postlens.sources.fixture import table

    df = skills.word_counts(table(spark, SF_SMALL, "documents", ["text"]), "text", schema.STOP_WORDS)
    text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert schemas and all(s == "struct<text:string>" for s in schemas)


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_full_report_is_one_aggregate_exchange_over_one_scan(spark):
    posts = registry.fixture_postings(spark, SF_SMALL)
    path = registry.scratch_path(spark, "plan-postings")
    posts.write.mode("overwrite").parquet(path)
    plan = final_plan(report.full_report(spark.read.parquet(path), keyword_dictionary(spark)))
    # A dictionary that is broadcast filters the tokens first: nothing but the counted cells is shuffled.
    assert plan.count("FileScan") == 1 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(report.full_report(spark.read.parquet(path), keyword_dictionary(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # A larger one: counted once, used by both branches.
    assert plan.count("FileScan") == 1, plan
    assert len(re.findall(r"Exchange hashpartitioning\(section", plan)) - plan.count("ReusedExchange") == 1
    assert plan.count("ReusedExchange") == 1


def test_small_and_large_dictionaries_count_alike(spark):
    posts, d = registry.fixture_postings(spark, SF_SMALL), keyword_dictionary(spark)

    def counted():
        rows = report.full_report(posts, d).collect()
        stream = registry.stream_report.running_counts(registry.stream_report.stream_rows(posts, d, registry.skills.dictionary_needs(d))).collect()
        words = registry.skills.keyword_counts(posts, d).collect()
        return [sorted(map(tuple, r)) for r in (rows, stream, words)]

    small = counted()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert counted() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_cell_is_spread_before_a_shuffle_join_with_the_dictionary(spark):
    rows = spark.range(4000).select(F.lit("other").alias("metric"), F.when(F.col("id") > 9, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = keep_dictionary_tokens(rows, keyword_dictionary(spark), "metric", "skills", ["metric", "key"], small=False)
        plan = executed(df)
        assert "hashpartitioning(key" in plan and "_slice" in plan.split("hashpartitioning(key")[1].split(")")[0]
        assert df.count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_dictionary_never_shuffles_the_fixed_cells(spark):
    """With broadcasts off, only the branch of the counted tokens is shuffled for the join."""
    counted = spark.createDataFrame([("salary_0", "1-2", 5), ("skill_bg", "java", 3), ("skill_bg", "zzz", 9)], "section string, key string, n long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = keep_dictionary_counts(counted, keyword_dictionary(spark), "section", "skill_bg", ["section", "key", "n"])
        plan = df._jdf.queryExecution().sparkPlan().toString()
        union = plan.index("Union")
        fixed = plan[union:].split("SortMergeJoin")[0]
        assert "SortMergeJoin" in plan and "Join" not in fixed
        assert sorted(map(tuple, df.collect())) == [("salary_0", "1-2", 5), ("skill_bg", "java", 3)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pivot_reads_the_store_once(spark):
    plan = final_plan(registry.q_cell_store_pivot(spark, SF_SMALL))
    assert plan.count("FileScan") == 1 and len(re.findall("Exchange", plan)) == 1
    assert store.CELL_COLUMNS
