"""Documents kept up in update mode: equal to those of the whole state, only changed ones written."""

import pytest
from pyspark.sql import functions as F

from postlens import fs
from postlens.functions.jsonfmt import chunked, doubled
from postlens.plans import registry
from postlens.session import scratch_path
from postlens.streaming import report
from tests.conftest import SF_SMALL

CELLS = "metric string, dim string, key string, n long"
JOB = 'j:"b'


def documents(df):
    return {r["key"]: r["value"] for r in df.collect()}


def written(spark, path, batch):
    return spark.read.parquet(f"{path}/delta={batch}")


def test_chunk_numbers_agree(spark):
    sizes = [1, 2, 4, 5, 8, 9, 63, 64, 65]
    df = spark.createDataFrame([(f"g{n}", f"k{i}") for n in sizes for i in range(n)], "g string, key string")
    for entries in (1, 4):
        most = {r["g"]: r["c"] for r in chunked(df, ["g"], "key", entries, doubling=True).groupBy("g").agg(F.max("chunk").alias("c")).collect()}
        assert all(most[f"g{n}"] < doubled(n, entries) for n in sizes)
    assert [doubled(n, 4) for n in (0, 1, 4, 5, 8, 9, 17)] == [1, 1, 1, 2, 2, 4, 8]


def test_batches_write_what_they_change(spark):
    """Sections that outgrow their chunks, a replayed batch, full views; after each batch as from all totals."""
    path, totals = f"{scratch_path(spark, 'docs')}/run=0", {}

    def batch(number, cells, replay=False):
        for _ in range(2 if replay else 1):
            df = spark.createDataFrame([(*c, n) for c, n in cells.items()], CELLS)
            report._write_documents(spark, df, path, JOB, number, False, 3, 4)
        totals.update(cells)
        want = documents(report.json_documents(spark.createDataFrame([(*c, n) for c, n in totals.items()], CELLS), JOB, entries=4))
        assert documents(report.stored_documents(spark, path.rpartition("/")[0])) == want
        return want

    some = [("skills", "", k) for k in ("java", 'a"b\\', "算法", "")] + [("salary_floor", "", "0-1")] + [("other", d, f"v{i}#1") for d in ("address", "education") for i in range(2)]
    assert len(batch(0, {c: 1 for c in some})) == 3
    # One cell that is there already: its document alone.
    batch(1, {("skills", "", "java"): 7})
    assert [r["row_key"] for r in written(spark, path, 1).collect()] == [f"{JOB}:{report.SECTIONS['skills']}"]
    batch(2, {("skills", "", f"k{i}"): i for i in range(30)}, replay=True)  # grows, and a full view
    batch(3, {("other", "address", f"w{i}"): i for i in range(25)})
    many = batch(4, {("salary_ceiling", "", "5-9"): 1, ("skills", "", "k3"): 99, ("other", "education", "v0#1"): 5})
    assert len(many) > 12 and written(spark, path, 4).count() == 3


def test_a_document_left_without_cells_goes(spark):
    path = f"{scratch_path(spark, 'docs-left')}/run=0"
    cells = {}
    for number in range(4):  # a key a document: some chunks of a doubled section stay empty
        cells[("skills", "", f"x{number}")] = number
        report._write_documents(spark, spark.createDataFrame([("skills", "", f"x{number}", number)], CELLS), path, "j", number, False, 20, 1)
        want = documents(report.json_documents(spark.createDataFrame([(*c, n) for c, n in cells.items()], CELLS), "j", entries=1))
        assert documents(report.stored_documents(spark, path.rpartition("/")[0])) == want


def test_a_broken_document_is_an_error(spark):
    path = f"{scratch_path(spark, 'docs-broken')}/run=0"
    report._write_documents(spark, spark.createDataFrame([("skills", "", "a", 1)], CELLS), path, "j", 0, False, 20, 4)
    cells = spark.read.parquet(f"{path}/delta=0").withColumn("value", F.lit("{")).withColumn("version", F.lit(1).cast("bigint"))
    cells.write.parquet(f"{path}/delta=1")
    with pytest.raises(Exception, match="can't be read"):
        report._write_documents(spark, spark.createDataFrame([("skills", "", "b", 1)], CELLS), path, "j", 2, False, 20, 4)


def test_stream_with_restart(spark):
    lines, folder = registry.posting_lines(spark, SF_SMALL), scratch_path(spark, "docs-input")
    store_path, json_store, checkpoint = (scratch_path(spark, n) for n in ("docs-store", "docs-json", "docs-ckpt"))
    for rest in (0, 1):
        lines.where(F.col("id") % 2 == rest).select(F.col("line").alias("value")).write.mode("append").text(folder)
        registry.drain(spark, folder, store_path, checkpoint, json_store=json_store, job="j", output_mode="update", json_entries=8, full_every=2)
    want = documents(report.json_documents(report.totals(spark, store_path), "j", entries=8))
    assert documents(report.stored_documents(spark, json_store)) == want and len(want) > 8
    assert fs.exists(spark, f"{json_store}/run=0")
