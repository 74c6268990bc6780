import hashlib
import random

from postlens.llm import linededup, queries
from tests.llm.support import DOCS, ODD, doc, frame, write_tables

STRIPPED = " \t\n\v\f\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIPPED))


def brute(rows, min_chars=20, min_docs=3):
    """(id, n_lines, n_dropped, text) of each (id, text) row."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders.setdefault(key_of(line), set()).add(i)
    keeper = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [line for line in lines if key_of(line) not in keeper or keeper[key_of(line)] == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def check(spark, rows, **parameters):
    df = frame(spark, rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in linededup.dedup_lines(df, **parameters).collect()]
    assert sorted(got, key=str) == brute(rows, **parameters)


def test_random_lines_against_brute_force(spark):
    rng = random.Random(3)
    pool = [f"a common line number {k} of many words" for k in range(12)] + ["short", "", "  ", "exactly twenty chars", "nineteen chars here", "É" * 20, "é" * 20, "漢" * 20, "漢" * 19]

    def line():
        base = rng.choice(pool) if rng.random() < 0.7 else f"a line of its own {rng.random()}"
        return rng.choice(("", " ", "\t\r", "\v\f ")) + rng.choice((base, base.upper(), base.title())) + rng.choice(("", "  ", "\r", " ", " "))

    check(spark, [(i, "\n".join(line() for _ in range(rng.randrange(0, 9)))) for i in range(150)])


def test_odd_rows(spark):
    same = "this very line is in all of them"
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, same), (None, same + "\n" + same), (50, same), (50, same + "\nmore"), (51, f"\n{same}\n"), (51, f"\n{same}\n"), (52, f"x\n{same}\n\n{same.upper()}")]
    rows += [(-60, "\n".join(f"line {k % 4000} of a very long document" for k in range(9000))), (61, "\n".join(f"line {k} of a very long document" for k in range(0, 4000, 2))), (62, "\n".join(f"LINE {k} of a very long document" for k in range(0, 4000, 3)))]
    check(spark, rows)
    # Three rows of one id are one document, and rows without an id are one too.
    check(spark, [(1, same)] * 3 + [(None, same)] * 3)
    check(spark, [(1, same)] * 3 + [(None, same)] * 3 + [(0, same)])
    check(spark, [])


def test_hot_keys_take_the_broadcast_way(spark, monkeypatch):
    monkeypatch.setattr(linededup, "HOT_SHARE", 5)
    rows = [(i, "\n".join(["one line in every document", f"one line in some {i % 20}: documents", f"own {i} of this document only"])) for i in range(200)]
    check(spark, rows)
    check(spark, rows, min_docs=11, min_chars=5)


def test_other_columns_and_names(spark):
    df = frame(spark, [(1, "l" * 30, "q", 7), (2, "l" * 30, "r", 8), (3, "l" * 30, None, 9)], "id int, `body text` string, _id string, n_lines int")
    got = linededup.dedup_lines(df, "id", "body text")
    assert got.columns == ["id", "body text", "_id", "n_lines", "n_dropped"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "", "q", 1, 1), (2, "", "r", 1, 1), (3, "l" * 30, None, 1, 0)]


def test_query_digests_the_kept_text(spark, tmp_path):
    same = "this very line is in all of them"
    rows = [doc(1, same), doc(2, f"{same}\nb"), doc(3, same), doc(4, None)]
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_line_dedup(spark, write_tables(spark, tmp_path, documents=(rows, DOCS))).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (1, 1, digest("")), 2: (2, 1, digest("b")), 3: (1, 0, digest(same)), 4: (1, 0, digest(""))}


def test_no_python_in_the_plan(spark):
    plan = linededup.dedup_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
