"""Dimension counts, labels, JSON, ranks; one aggregate exchange for all five dimensions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.functions.parse import gate, postings
from postlens.operators import dimensions
from postlens.operators.rank import row_number_within
from tests.conftest import plan_text
from tests.test_parse import lines


def test_counts_skip_empty_values(spark):
    p = gate(postings(lines(spark)), min_fields=10)
    got = {(r["dim"], r["value"]): r["n"] for r in dimensions.counts(p).collect()}
    assert got[("address", "北京")] == 2  # rows 1, 2 (row 3 has 9 fields; row 6 an empty address)
    assert got[("companyPnum", "20-99人")] == 2
    assert ("address", "") not in got
    assert got[("education", "本科")] == 3  # rows 1, 2, 6 (row 3 has 9 fields; gated out)


def test_labels(spark):
    p = gate(postings(lines(spark)), min_fields=10)
    labels = {r["label"] for r in dimensions.labelled_counts(p).collect()}
    assert labels == {"地址", "公司类型", "公司规模", "经验", "学历"}


def test_json_sorted_keys(spark):
    df = spark.createDataFrame([("d", "b", 2), ("d", "a", 5)], "dim string, value string, n long")
    assert dimensions.as_json(df).collect()[0]["json"] == '{"a":5,"b":2}'


def test_single_aggregate_exchange(spark):
    p = gate(postings(lines(spark)), min_fields=10)
    plan = plan_text(dimensions.counts(p))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_distributed_rank_equals_window_rank(spark):
    rows = [(f"d{i % 3}", f"v{i:04d}", (i * 37) % 11) for i in range(600)]
    df = spark.createDataFrame(rows, "dim string, value string, n long").repartition(5)
    mine = row_number_within(df, ["dim"], [F.col("n").desc(), F.col("value").asc()])
    w = Window.partitionBy("dim").orderBy(F.col("n").desc(), F.col("value").asc())
    ref = df.withColumn("rnk", F.row_number().over(w))
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, ref.collect()))


def test_global_rank_without_groups(spark):
    df = spark.createDataFrame([(f"t{i}", i % 7) for i in range(300)], "token string, n long").repartition(4)
    got = row_number_within(df, [], [F.col("n").desc(), F.col("token").asc()]).collect()
    assert sorted(r["rnk"] for r in got) == list(range(1, 301))
    best = min(got, key=lambda r: r["rnk"])
    assert best["n"] == 6


def test_write_by_dimension(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("a", "z", 3)], "dim string, value string, n long")
    dimensions.write_by_dimension(df, str(tmp_path / "d"))
    assert sorted(p.name for p in (tmp_path / "d").iterdir() if p.is_dir()) == ["dim=a", "dim=b"]
    assert sorted(r["value"] for r in spark.read.parquet(str(tmp_path / "d/dim=a")).collect()) == ["x", "z"]


def test_large_json_is_chunked(spark):
    import json

    from postlens.functions.jsonfmt import chunk_name, chunked, json_object

    df = spark.createDataFrame([("big", f"k{i}", i) for i in range(500)] + [("small", "k", 1)], "dim string, value string, n long")
    docs = chunked(df, ["dim"], "value", entries=50).groupBy("dim", "chunk").agg(json_object("value", "n").alias("json"))
    got = {r["name"]: json.loads(r["json"]) for r in docs.select(chunk_name(F.col("dim")).alias("name"), "json").collect()}
    assert got["small"] == {"k": 1} and len(got) == 11 and max(map(len, got.values())) < 100
    merged = {k: v for name, doc in got.items() if name.startswith("big") for k, v in doc.items()}
    assert merged == {f"k{i}": i for i in range(500)}


def test_dimension_totals_equal_non_empty_cells(spark):
    from tests.conftest import SF_SMALL
    from postlens.plans.registry import fixture_postings

    p = gate(fixture_postings(spark, SF_SMALL), min_fields=10)
    totals = {r["dim"]: r["t"] for r in dimensions.counts(p).groupBy("dim").agg(F.sum("n").alias("t")).collect()}
    for col, qual, _ in [("address", "address", 0), ("company_type", "companyType", 0), ("education", "education", 0)]:
        assert totals[qual] == p.where(F.col(col) != "").count()


def test_rank_of_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "dim string, value string, n long")
    assert row_number_within(empty, ["dim"], [F.col("n").desc(), F.col("value")]).count() == 0
    one = spark.createDataFrame([("d", "v", 3)], "dim string, value string, n long")
    assert [tuple(r) for r in row_number_within(one, ["dim"], [F.col("n").desc()]).collect()] == [("d", "v", 3, 1)]


def test_json_object_escapes_keys(spark):
    import json

    keys = ['a"b', "c\\d", "e\nf", "北京", "/x"]
    df = spark.createDataFrame([("d", k, i) for i, k in enumerate(keys)], "dim string, value string, n long")
    doc = json.loads(dimensions.as_json(df).collect()[0]["json"])
    assert doc == {k: i for i, k in enumerate(keys)}
    assert list(doc) == sorted(keys)  # keys in code-point order
