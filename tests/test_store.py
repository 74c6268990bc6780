"""Result store: latest view, idempotent batches, pivot, text form, key listing."""

import random

import pytest
from pyspark.sql import functions as F

from postlens.operators import store
from postlens.session import scratch_path

CELLS = [
    ("r1", "info", "a", "1", 1),
    ("r1", "info", "a", "2", 5),
    ("r1", "info", "b", "x", 2),
    ("r2", "info", "a", "y", 3),
    ("r2", "other", "a", "z", 9),
]


def cells(spark, rows=CELLS):
    return spark.createDataFrame(rows, store.CELL_SCHEMA)


def test_latest_wins_and_is_order_independent(spark):
    rows = list(CELLS)
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = sorted(map(tuple, store.latest(cells(spark, rows).repartition(3)).collect()))
        want = want or got
        assert got == want
    assert ("r1", "info", "a", "2", 5) in want


def test_batches_are_idempotent(spark):
    path = scratch_path(spark, "test-store")
    store.write_cells(cells(spark), path, "one", 0)
    store.write_cells(cells(spark), path, "one", 0)  # replay of run 0
    store.write_cells(cells(spark, [("r1", "info", "a", "3", 7)]), path, "two", 0)  # another job
    all_cells = store.read_cells(spark, path)
    assert all_cells.count() == len(CELLS) + 1
    latest = {(r["row_key"], r["family"], r["qualifier"]): r["value"] for r in store.latest(all_cells).collect()}
    assert latest[("r1", "info", "a")] == "3"


def test_pivot_and_text(spark):
    latest = store.latest(cells(spark))
    piv = {r["row_key"]: (r["a"], r["b"]) for r in store.pivot(cells(spark), ["a", "b"], "info").collect()}
    assert piv == {"r1": ("2", "x"), "r2": ("y", None)}
    text = {r["row_key"]: r["text"] for r in store.as_text(latest, "info").collect()}
    assert text == {"r1": "a:2\tb:x", "r2": "a:y"}
    wide = cells(spark, [("w", "info", f"q{i:03}", str(i), 1) for i in range(100)])
    parts = store.as_text(wide, entries=10).collect()
    assert len(parts) > 5 and sorted(p for r in parts for p in r["text"].split("\t")) == [f"q{i:03}:{i}" for i in range(100)]


def test_keys_glob(spark):
    df = cells(spark)
    assert sorted(r["row_key"] for r in store.keys(df).collect()) == ["r1", "r2"]
    assert [r["row_key"] for r in store.keys(df, "*1").collect()] == ["r1"]
    assert store.glob_regex("job:*") == "(?s)^job:.*\\z"


def test_as_cells_casts(spark):
    df = spark.createDataFrame([(7, "t", "{}", 3)], "user_id long, q string, v string, ver int")
    out = store.as_cells(df, "user_id", F.lit("info"), "q", "v", "ver")
    assert out.dtypes == [("row_key", "string"), ("family", "string"), ("qualifier", "string"),
                          ("value", "string"), ("version", "bigint")]


def test_runs_grow_and_are_read_apart(spark):
    path = scratch_path(spark, "test-store-runs")
    first = store.new_run(spark, path)
    store.write_cells(cells(spark), path, "one", first)
    store.write_cells(cells(spark, [("r9", "info", "a", "9", 8)]), path, "one", first + 1)
    assert store.new_run(spark, path) == first + 2
    assert [r["row_key"] for r in store.read_cells(spark, path, "one", first + 1).collect()] == ["r9"]
    assert {(r["job"], r["run"]) for r in store.read_cells(spark, path).collect()} == {("one", first), ("one", first + 1)}


def test_pivot_is_one_shuffle(spark):
    plan = store.pivot(cells(spark), ["a", "b"], "info")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_glob_matches_fnmatch(spark):
    import fnmatch

    rnd = random.Random(21)
    alphabet = ["a", "b", ":", ".", "+", "(", "职", "\n"]
    keys = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 5))) for _ in range(60)]
    patterns = ["".join(rnd.choice(alphabet + ["*", "?"]) for _ in range(rnd.randint(1, 4))) for _ in range(15)]
    df = spark.createDataFrame([(k,) for k in keys], "row_key string")
    for pat in patterns:
        got = sorted(r["row_key"] for r in df.where(F.col("row_key").rlike(store.glob_regex(pat))).collect())
        assert got == sorted(k for k in keys if fnmatch.fnmatchcase(k, pat)), pat


def view(spark, path, job=None):
    return sorted(map(tuple, store.latest(store.read_cells(spark, path, job)).collect()))


def filled(spark, runs=6):
    """A store of two jobs, and what its runs hold."""
    path = scratch_path(spark, "test-compact")
    for k in range(runs):
        run = store.new_run(spark, path)
        assert run == k
        rows = [(f"r{i:02}", "info", q, f"{q}{k}", run) for i in range(k, 12) for q in "ab"]
        store.write_cells(cells(spark, rows), path, ("x", "y")[k % 2], run)
    return path


def files(df):
    return set(df.inputFiles())


def test_a_compacted_store_reads_as_before(spark):
    path = filled(spark)
    before = view(spark, path), view(spark, path, "x"), view(spark, path, "y")
    assert store.compact(spark, path) == 5
    assert (view(spark, path), view(spark, path, "x"), view(spark, path, "y")) == before
    assert not any("run=" in f for f in files(store.read_cells(spark, path)))
    # Later runs are read beside the snapshot, and the next snapshot takes both.
    run = store.new_run(spark, path)
    store.write_cells(cells(spark, [("r00", "info", "a", "new", run)]), path, "x", run)
    assert ("r00", "info", "a", "new", run) in view(spark, path) and sum("run=" in f for f in files(store.read_cells(spark, path))) >= 1
    after = view(spark, path)
    assert store.compact(spark, path) == run and store.compact(spark, path) is None and view(spark, path) == after


def test_a_crash_before_the_pointer_changes_nothing(spark, monkeypatch):
    path = filled(spark)
    before = view(spark, path)

    def die(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(store.fs, "write_new", die)
        with pytest.raises(RuntimeError):
            store.compact(spark, path)
    assert view(spark, path) == before and store._snapshot(spark, path) == (None, -1)
    assert store.compact(spark, path) == 5 and view(spark, path) == before


def test_two_compactions_at_once_leave_one_pointer(spark, monkeypatch):
    path = filled(spark)
    real = store.fs.write_new

    def slower(session, target, text):
        with monkeypatch.context() as m:
            m.setattr(store.fs, "write_new", real)
            assert store.compact(spark, path) == 5  # another driver's, meanwhile
        return real(session, target, text)

    with monkeypatch.context() as m:
        m.setattr(store.fs, "write_new", slower)
        assert store.compact(spark, path) is None
    assert store._pointers(spark, path) == [0]


def test_unfinished_runs_and_covered_runs(spark):
    path = filled(spark)
    held = store.new_run(spark, path)  # opened, not written yet
    run = store.new_run(spark, path)
    store.write_cells(cells(spark, [("r99", "info", "a", "z", run)]), path, "x", run)
    assert store.compact(spark, path) == held - 1
    store.write_cells(cells(spark, [("r98", "info", "a", "late", held)]), path, "y", held)
    rows = {r[0] for r in view(spark, path)}
    assert {"r98", "r99"} <= rows
    with pytest.raises(ValueError, match="snapshot"):
        store.write_cells(cells(spark), path, "x", 2)


def test_vacuum_keeps_what_earlier_readers_listed(spark):
    path = filled(spark)
    early = store.read_cells(spark, path)
    store.compact(spark, path)
    middle = store.read_cells(spark, path)
    run = store.new_run(spark, path)
    store.write_cells(cells(spark, [("r00", "info", "a", "new", run)]), path, "x", run)
    assert store.vacuum(spark, path) == [] and early.count() > 0
    store.compact(spark, path)
    now = view(spark, path)
    assert any("run=0" in p for p in store.vacuum(spark, path))
    assert view(spark, path) == now and middle.count() > 0 and store.new_run(spark, path) == run + 1


def test_row_and_prefix_scans_read_few_files(spark):
    path = scratch_path(spark, "test-scan")
    rows = [(f"{i:05}", "info", "a", str(i), 0) for i in range(4000)]
    store.write_cells(spark.createDataFrame(rows, store.CELL_SCHEMA).repartition(8), path, "x", 0)
    assert store.compact(spark, path) == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run = store.new_run(spark, path)
        store.write_cells(cells(spark, [("00010", "info", "a", "new", run)]), path, "x", run)
        store.compact(spark, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = store.read_cells(spark, path)
    found = store.rows_between(whole, "00100", "00110")
    assert sorted(r["row_key"] for r in found.collect()) == [f"{i:05}" for i in range(100, 110)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,00100)" in plan and "LessThan(row_key,00110)" in plan
    assert [r["row_key"] for r in store.rows_between(whole, "03999").collect()] == ["03999"]
    prefixed = store.rows_with_prefix(whole, "0001")
    assert prefixed.count() == 10 and "StringStartsWith(row_key,0001)" in prefixed._jdf.queryExecution().executedPlan().toString()
    # Clustered by key: the file that holds a key's range holds no other part of the keys.
    by_file = whole.groupBy(F.input_file_name().alias("f")).agg(F.min("row_key").alias("lo"), F.max("row_key").alias("hi")).orderBy("lo").collect()
    assert len(by_file) > 2 and all(a["hi"] < b["lo"] for a, b in zip(by_file, by_file[1:]))
