import numpy as np
import pytest

import corpus_pipeline as cp
from postlens.llm import queries
from tests.llm.support import DOCS, SF, SPACES, doc, frame, write_tables
from tests.llm.test_jaccard import brute as near_classes
from tests.llm.test_packing import sequences

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after every stage but the last, and the packed pieces."""
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        after = stage(spark, docs, SF)
        after.write.parquet(f"{base}/{k}")
        after = spark.read.parquet(f"{base}/{k}")
        out.append((docs, after))
        docs = after
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert all(after.dtypes == columns for _, after in stages[:-1])


def test_quality_keeps_what_the_classifier_predicts_good(spark, stages):
    before, after = stages[0]
    good = {r["doc_id"] for r in queries.op6_quality_classifier(spark, SF).where("predicted = 1").collect()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(good) and 0 < len(good) < before.count()


def test_exact_dedup_keeps_the_smallest_of_equal_texts(stages):
    before, after = stages[1]
    least = {}
    for r in before.collect():
        key = SPACES.sub(" ", r["text"] or "")
        least[key] = min(least.get(key, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(least.values())


def test_near_dedup_keeps_one_of_each_class(stages):
    before, after = stages[2]
    classes = near_classes([(r["doc_id"], r["text"]) for r in before.collect()])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({c for _, c, _ in classes})


def test_mixing_takes_what_the_operator_decides(stages):
    from postlens.llm import mixing

    before, after = stages[3]
    took = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == took


def test_packing_holds_every_id(stages):
    before, after = stages[4]
    rows = after.collect()
    sequences(rows)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before.collect()}
    per_doc = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        per_doc[r["doc_id"]] = per_doc.get(r["doc_id"], 0) + r["length"]
    copies = {r["doc_id"]: r["count"] for r in before.groupBy("doc_id").count().collect()}
    assert all(per_doc[r["doc_id"]] == r["doc_tokens"] * copies[r["doc_id"]] for r in rows)


def test_odd_and_empty_documents(spark, tmp_path):
    rows = [doc(1, None), doc(2, ""), doc(2, ""), (None, "x y z", None, None, None), doc(4, "x y z"), doc(5, "words " * 50)]
    path = write_tables(spark, tmp_path / "odd", documents=(rows, DOCS), labels=([(1, None, None), (5, 1, 0)], LABELS))
    out = cp.run(spark, path).collect()
    sequences(out)
    path = write_tables(spark, tmp_path / "none", documents=([], DOCS), labels=([], LABELS))
    assert cp.run(spark, path).count() == 0
    assert np.isfinite([r["length"] for r in out]).all()
