import hashlib

from postlens.llm import dedup, queries
from tests.llm.support import DOCS, ODD, SF, SPACES, doc, frame, write_tables


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(SPACES.sub(" ", text or ""), []).append(i)
    return sorted((i, min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)


def test_query_equals_brute_force(spark, tmp_path):
    texts = ODD + ["a b", "a\tb", "a \n b", " a b", "a b ", "A b"] * 3 + ["hot text " * 20] * 300
    rows = [doc(100 - i, t) for i, t in enumerate(texts)]
    got = queries.op5_exact_dedup(spark, write_tables(spark, tmp_path, documents=(rows, DOCS)))
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == brute([(r[0], r[1]) for r in rows])


def test_hot_text_is_salted_and_put_together(spark):
    rows = [(i, "copy " * 50 if i % 2 else f"own {i} " * 10) for i in range(2000)]
    df = frame(spark, rows, "doc_id long, text string")
    hot = dedup.hot_texts(df, "text", 8).collect()
    assert len(hot) == 1 and hot[0]["_pieces"] > 1
    assert sorted(tuple(r) for r in dedup.mark_duplicates(df, carry=False).collect()) == brute(rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "x", "k", 9), (1, "x", "k", 9), (None, "x", "k", 1), (None, "y", None, None), (2, "z", "k", 3)]
    df = frame(spark, rows, "doc_id long, text string, kept string, _norm int")
    out = dedup.exact_dedup(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "x", "k", 9), (None, "y", None, None), (2, "z", "k", 3)], key=str)
    assert dedup.mark_duplicates(df).columns == ["doc_id", "text", "_norm", *dedup.ADDED]


def test_empty_table(spark):
    assert dedup.exact_dedup(frame(spark, [], DOCS)).count() == 0


def test_no_python_and_one_text_shuffle(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = dedup._marked(df, "doc_id", "text", [])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
