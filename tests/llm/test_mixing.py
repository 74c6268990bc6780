import random
import re

import numpy as np
import pytest

from postlens.llm import mixing, queries
from tests.llm.support import DOCS, ODD, SF, doc, frame, write_tables


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Water filling, round by round."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, closed = 1.5 * sum(sizes.values()), {}
    while True:
        unit = sum(weight[s] for s in names if s not in closed)
        share = {s: left * weight[s] / unit for s in names if s not in closed}
        over = [s for s in share if share[s] > 2 * sizes[s]]
        if not over:
            return closed | share
        for s in over:
            closed[s] = 2.0 * sizes[s]
        left = 1.5 * sum(sizes.values()) - sum(closed.values())


def check(rows, got):
    assert len(got) == len(rows)
    size = {r[0]: words(r[1]) for r in rows}
    by = {}
    for r in rows:
        by[r[3]] = by.get(r[3], 0) + size[r[0]]
    want = targets(by)
    taken = dict.fromkeys(by, 0)
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    return want, taken


def test_query_equals_brute_force_and_fits_targets(spark, tmp_path):
    rng = random.Random(3)
    rows = [doc(i, t, source=rng.choice(["b", "é", None, "", "Z"])) for i, t in enumerate(ODD)]
    rows += [doc(100 + i, "w " * rng.randint(1, 60), source=rng.choice(["hot"] * 6 + ["b", "é", None, "", "Z"])) for i in range(900)]
    rows += [doc(2000 + i, "only one", source="tiny") for i in range(2)]
    path = write_tables(spark, tmp_path, documents=(rows, DOCS))
    first, again = queries.op10_source_mixing(spark, path), queries.op10_source_mixing(spark, path)
    want, taken = check(rows, first.collect())
    assert sorted(first.collect()) == sorted(again.collect())
    for s in want:
        assert abs(taken[s] - want[s]) <= 1.0, (s, taken[s], want[s])


def test_query_on_driver_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want, taken = check(rows, queries.op10_source_mixing(spark, SF).collect())
    assert abs(sum(taken.values()) / sum(want.values()) - 1) < 0.01


@pytest.mark.parametrize("seed", range(6))
def test_knapsack_is_exact(seed):
    rng = random.Random(seed)
    lengths = rng.sample(range(1, 60), 8)
    counts = [rng.randint(0, 5) for _ in lengths]
    sums = {0}
    for n, c in zip(lengths, counts):
        sums = {s + n * k for s in sums for k in range(c + 1)}
    for budget in (0, 1, 17, 95, 400, 10_000):
        took = mixing.knapsack(lengths, counts, budget)
        assert all(took[n] <= counts[lengths.index(n)] for n in took)
        assert sum(n * k for n, k in took.items()) == max(s for s in sums if s <= budget)


def test_counts_fill_large_budgets_exactly():
    rng = np.random.default_rng(1)
    sizes, counts = np.arange(0, 3000), rng.integers(1, 400, 3000)
    rest = float(int((sizes * counts).sum() * 0.37))
    chosen = mixing.fit_counts(sizes, counts, rest)
    assert (chosen <= counts).all() and int((chosen * sizes).sum()) == rest


def test_documents_repeat_as_taken(spark):
    rows = [doc(i, "w " * (i % 7 + 1), source="ab"[i % 2]) for i in range(200)] + [doc(7, "w " * 2, source="b")] * 3
    df = frame(spark, rows, DOCS + "").withColumnRenamed("n_chars", "size")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert out.count() == mixing.mix(df).selectExpr("sum(copies)").first()[0]
    assert out.groupBy("doc_id").count().where("doc_id <> 7").selectExpr("max(count)").first()[0] <= 2


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [], DOCS)).count() == 0
    assert mixing.mixed_documents(frame(spark, [], DOCS)).count() == 0
