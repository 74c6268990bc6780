"""State read from a checkpoint, stores rebuilt from it, documents read back."""

from pyspark.sql import functions as F

from postlens import fs
from postlens.plans import registry
from postlens.session import scratch_path
from postlens.streaming import report
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_lost_store_is_rebuilt_and_the_query_goes_on(spark):
    lines, folder = registry.posting_lines(spark, SF_SMALL), scratch_path(spark, "state-input")
    store_path, checkpoint = scratch_path(spark, "state-store"), scratch_path(spark, "state-ckpt")
    lines.where("id % 2 = 0").select(F.col("line").alias("value")).write.mode("append").text(folder)
    registry.drain(spark, folder, store_path, checkpoint)
    half = rows(report.totals(spark, store_path))
    assert rows(report.state_totals(spark, checkpoint)) == half and report.differences(spark, checkpoint, store_path).count() == 0
    fs.delete(spark, store_path)
    report.rebuild(spark, checkpoint, store_path)
    assert rows(report.totals(spark, store_path)) == half
    lines.where("id % 2 <> 0").select(F.col("line").alias("value")).write.mode("append").text(folder)
    registry.drain(spark, folder, store_path, checkpoint)
    whole = rows(report.totals(spark, store_path))
    assert whole == rows(registry.q_stream_report(spark, SF_SMALL)) == rows(report.state_totals(spark, checkpoint))
    # An earlier batch's state is still there, and a store that lags behind is told.
    before = report.last_batch(spark, checkpoint) - 1
    assert len(rows(report.state_totals(spark, checkpoint, before))) <= len(whole)
    newest = max(n for n in fs.children(spark, f"{store_path}/run=0") if n.startswith("delta="))
    fs.delete(spark, f"{store_path}/run=0/{newest}")
    assert report.differences(spark, checkpoint, store_path).count() > 0


def test_rebuild_before_any_batch_writes_nothing(spark):
    path = scratch_path(spark, "state-none")
    report.rebuild(spark, scratch_path(spark, "state-none-ckpt"), path)
    assert fs.children(spark, path) == []


TOTALS = [("skills", "", k, n) for k, n in (("java", 3), ('a"b\\', 1), ("算法", 2))] + [("salary_floor", "", "0-1", 9), ("other", "address", "x:y#1", 4), ("other", "education", "", 5)]


def test_documents_round_trip(spark):
    df = spark.createDataFrame(TOTALS, "metric string, dim string, key string, n long")
    want = sorted(("j", report.SECTIONS[m], d, k, n, None) for m, d, k, n in TOTALS)
    for nested in (False, True):
        assert sorted(map(tuple, report.read_documents(report.json_documents(df, "j", nested=nested)).collect())) == want


def test_chunks_come_together_and_broken_documents_are_told(spark, monkeypatch):
    many = spark.createDataFrame([("skills", "", f"k{i}", i) for i in range(300)], "metric string, dim string, key string, n long")
    docs = report.chunked(many, ["metric", "dim"], "key", 20)
    docs = docs.groupBy("chunk").agg(report.sorted_map("key", "n").alias("m"))
    docs = docs.select(report.chunk_name(F.lit("j:" + report.SECTIONS["skills"])).alias("key"), report.envelope("j", F.to_json(F.create_map(F.lit(report.SECTIONS["skills"]), F.col("m")))).alias("value"))
    assert docs.count() > 5 and {(r["key"], r["n"]) for r in report.read_documents(docs).collect()} == {(f"k{i}", i) for i in range(300)}
    broken = ["", "{", "[]", "{}", '{"j":"x"}', '{"j":"{\\"s\\":{\\"k\\":\\"many\\"}}"}', '{"j":{"s":5}}', None]
    df = spark.createDataFrame([("j:s", v) for v in broken] + [("j:s", '{"j":"{\\"s\\":{}}"}')], "key string, value string")
    got = report.read_documents(df).collect()
    assert all(r["n"] is None and r["section"] == "s" for r in got) and sorted(str(r["broken"]) for r in got) == sorted(map(str, broken))
