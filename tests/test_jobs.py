"""End-to-end jobs over posting files: cells per file equal the in-memory report."""

import glob
import json


from postlens.operators import store
from postlens.plans import jobs, report
from postlens.plans.registry import fixture_postings
from postlens.session import scratch_path
from postlens.sources.fixture import posting_lines
from postlens.sources.text import keyword_dictionary, read_lines, write_lines
from tests.conftest import SF_SMALL


def test_full_report_job_one_file_equals_report(spark):
    src = write_lines(posting_lines(spark, SF_SMALL), scratch_path(spark, "job-in"))
    store_path = scratch_path(spark, "job-store")
    cells = {r["qualifier"]: json.loads(r["value"]) for r in jobs.full_report_job(spark, src, store_path).collect()}
    rep = report.full_report(fixture_postings(spark, SF_SMALL), keyword_dictionary(spark)).collect()
    want = {}
    for r in rep:
        want.setdefault(r["section"], {})[r["key"]] = r["n"]
    assert cells == want


def test_salary_and_keyword_jobs(spark):
    src = write_lines(posting_lines(spark, SF_SMALL).repartition(2), scratch_path(spark, "job-in2"))
    store_path = scratch_path(spark, "job-store2")
    sal = jobs.salary_job(spark, src, store_path, side=1, source="file").collect()
    assert {r["qualifier"] for r in sal} == {"salary_1", "salary3_1"}
    assert len({r["row_key"] for r in sal}) == 2  # one report per file
    total = sum(sum(json.loads(r["value"]).values()) for r in sal if r["qualifier"] == "salary_1")
    assert total == 388
    kw = jobs.keyword_job(spark, src, store_path, source="file").collect()
    assert {r["qualifier"] for r in kw} == {"skill_bg"}
    merged = {}
    for r in kw:
        for k, v in json.loads(r["value"]).items():
            merged[k] = merged.get(k, 0) + v
    assert merged["java"] == 237 and merged["算法"] == 592


def test_word_count_job_tab_separated(spark, tmp_path):
    rows = ["\t".join(["x"] * 10 + ["Spark and spark the hive"]), "\t".join(["y"] * 5)]
    src = str(tmp_path / "in.txt")
    with open(src, "w", encoding="utf-8") as fh:
        fh.write("\n".join(rows) + "\n")
    out = str(tmp_path / "out")
    jobs.word_count_job(spark, src, out)
    lines = []
    for f in sorted(glob.glob(out + "/part-*")):
        lines += open(f, encoding="utf-8").read().splitlines()
    assert lines == ["(spark,2)", "(hive,1)"]


def test_keyword_job_with_dictionary_file(spark, tmp_path):
    dic = tmp_path / "java.web.dic"
    dic.write_text("Spark\nLinux\n数据挖掘\n\n", encoding="utf-8")
    src = write_lines(posting_lines(spark, SF_SMALL), scratch_path(spark, "job-in3"))
    cells = jobs.keyword_job(spark, src, scratch_path(spark, "job-store3"), dictionary_path=str(dic)).collect()
    assert [r["qualifier"] for r in cells] == ["skill_java"]
    assert json.loads(cells[0]["value"]) == {"linux": 1184, "spark": 237, "数据挖掘": 592}


def test_jobs_sharing_a_store_keep_each_others_cells(spark):
    src = write_lines(posting_lines(spark, SF_SMALL), scratch_path(spark, "job-shared"))
    other = write_lines(posting_lines(spark, SF_SMALL).where("id % 2 = 0"), scratch_path(spark, "job-shared"))
    cells = scratch_path(spark, "job-shared-store")
    for side in (1, 0):
        written = jobs.salary_job(spark, src, cells, side=side)
        assert written.select("job", "run").distinct().first()["run"] is not None
    jobs.keyword_job(spark, src, cells)
    jobs.salary_job(spark, other, cells, side=1)  # a second input path
    latest = store.latest(store.read_cells(spark, cells)).collect()
    name, second = src.rsplit("/", 1)[1], other.rsplit("/", 1)[1]
    assert {(r["row_key"], r["qualifier"]) for r in latest} == {
        *((name, q) for q in ("salary_0", "salary3_0", "salary_1", "salary3_1", "skill_bg")), *((second, q) for q in ("salary_1", "salary3_1"))}
    again = jobs.salary_job(spark, src, cells, side=1).collect()  # a rerun is a newer version of the same cells
    newest = {(r["row_key"], r["qualifier"]): r["version"] for r in store.latest(store.read_cells(spark, cells)).collect()}
    assert all(newest[r["row_key"], r["qualifier"]] == r["version"] for r in again)


def test_row_keys():
    from postlens.sources.text import row_keys

    assert row_keys("/data/in/java.txt") == {"java.txt": "/data/in/java.txt"}
    assert row_keys(["/a/x", "/b/y/"]) == {"x": "/a/x", "y": "/b/y/"}
    assert row_keys(["/a/x", "/b/x"]) == {"a/x": "/a/x", "b/x": "/b/x"}
    assert row_keys({"k": "/a"}) == {"k": "/a"}


def test_file_keys_are_decoded_and_apart(spark, tmp_path):
    name = "java 北京%+.txt"
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_text("a|b\n", encoding="utf-8")
    root = str(tmp_path)
    got = {r["source"] for r in read_lines(spark, [f"{root}/one", f"{root}/two"], source="file").collect()}
    assert got == {name}
    assert {r["source"] for r in read_lines(spark, f"{root}/*", source="file").collect()} == {f"one/{name}", f"two/{name}"}
    assert {r["source"] for r in read_lines(spark, f"{root}/one", source="path").collect()} == {"one"}


def test_cells_read_the_postings_once(spark):
    from pyspark.sql import functions as F

    from postlens.plans import report

    read = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: read.add(1) or x, "string").asNondeterministic()
    counted = spark.range(0, 40, 1, 2).select(F.lit("s").alias("section"), seen((F.col("id") % 5).cast("string")).alias("key")).groupBy("section", "key").count().withColumnRenamed("count", "n")
    cells = report.report_cells(counted, "row").collect()
    assert [r["value"] for r in cells] == ['{"0":8,"1":8,"2":8,"3":8,"4":8}']
    assert read.value == 40
