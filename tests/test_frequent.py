"""Frequent pairs against brute force: long lists, hot lists set aside, few buckets, odd input."""

import random
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlens.operators import frequent


def brute_force(lists, support):
    n = Counter(p for _, ms in lists for p in combinations(sorted(set(ms)), 2))
    return {(a, b, k) for (a, b), k in n.items() if k >= support}


def indexed(spark, lists):
    return spark.createDataFrame([(m, o) for o, ms in lists for m in ms], "member string, owner string")


def answer(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def lists():
    rnd = random.Random(5)
    names = [f"m{i:02d}" for i in range(40)]
    out = [(f"o{i:03d}", rnd.choices(names, weights=[1 / (k + 1) for k in range(40)], k=rnd.randint(0, 9))) for i in range(120)]
    # A few lists hold nearly all members, and so most listings.
    return out + [(f"hot{i}", rnd.sample(names, 36 + i)) for i in range(4)]


@pytest.mark.parametrize(("support", "block", "buckets"), [(1, 7, 1 << 20), (2, 256, 1 << 20), (3, 1, 64), (5, 5, 1), (9, 7, 64), (30, 7, 1 << 20)])
def test_as_brute_force(spark, lists, support, block, buckets):
    assert answer(frequent.frequent_pairs(indexed(spark, lists), support, block, buckets)) == brute_force(lists, support)


def test_lists_set_aside_are_counted(spark):
    lists = [(f"long{i}", [f"m{k:03d}" for k in range(50)]) for i in range(3)] + [("a", ["m000", "m001"]), ("b", ["m000", "m001"]), ("c", ["m000", "m002"])]
    got = answer(frequent.frequent_pairs(indexed(spark, lists), 5, block=10))
    assert got == {("m000", "m001", 5)} == brute_force(lists, 5)
    assert answer(frequent.frequent_pairs(indexed(spark, lists), 4, block=10)) == brute_force(lists, 4)


def test_odd_input(spark):
    rows = [("a", "1"), ("a", "1"), ("b", "1"), (None, "1"), ("a", None), ("b", "2"), ("a", "2"), ("", "1"), ("", "2")]
    index = spark.createDataFrame(rows, "member string, owner string").withColumn("number", F.lit(1)).withColumn("n", F.lit(2))
    assert answer(frequent.frequent_pairs(index, 2)) == {("a", "b", 2), ("", "a", 2), ("", "b", 2)}
    assert answer(frequent.frequent_pairs(index, 0)) == answer(frequent.frequent_pairs(index, 1))
    assert answer(frequent.frequent_pairs(index.limit(0), 2)) == set()


def test_pairs_of_hot_lists_are_never_made(spark, lists):
    index, support = indexed(spark, lists), 9
    seen = []
    before = frequent._pairs
    frequent._pairs = lambda met: seen.append(before(met).count()) or before(met)
    try:
        frequent.frequent_pairs(index, support, block=20)
    finally:
        frequent._pairs = before
    ordinary = [(o, ms) for o, ms in lists if not o.startswith("hot")]
    often = {m for m, n in Counter(m for _, ms in lists for m in set(ms)).items() if n >= support}
    assert seen[0] == sum(len(list(combinations(set(ms) & often, 2))) for _, ms in ordinary)


def test_pairs_are_counted_in_the_tasks(spark, lists, monkeypatch):
    monkeypatch.setattr(frequent, "_pairs", lambda met: pytest.fail("a row for each pair was made"))
    for block, chunk in ((7, 50), (256, 1 << 22)):
        monkeypatch.setattr(frequent, "CHUNK", chunk)
        assert answer(frequent.frequent_pairs(indexed(spark, lists), 3, block, buckets=64)) == brute_force(lists, 3)


def test_pairs_of_few_lists_are_not_shuffled(spark, monkeypatch):
    rnd = random.Random(6)
    lists = [(f"o{i:03d}", rnd.sample([f"m{k:03d}" for k in range(150)], 12)) for i in range(200)]
    seen, before = [], frequent._pair_counts
    monkeypatch.setattr(frequent, "_pair_counts", lambda *args: seen.append(before(*args).count()) or before(*args))
    expected = brute_force(lists, 4)
    assert expected and answer(frequent.frequent_pairs(indexed(spark, lists), 4, buckets=1)) == expected
    assert sum(seen) == len(expected)  # some 7,700 pairs are in a list


def test_many_cells_slices_rounds_and_folds(spark, lists, monkeypatch):
    for name, value in {"CELL": 60, "SLICE": 40, "TASK": 100, "CHUNK": 7, "FOLD": 30}.items():
        monkeypatch.setattr(frequent, name, value)
    slices, met, sent = [], [], (frequent._slices, frequent._met)
    monkeypatch.setattr(frequent, "_slices", lambda *args: slices.append(args[2:]) or sent[0](*args))
    monkeypatch.setattr(frequent, "_met", lambda *args: met.append(args[3:]) or sent[1](*args))
    for support, buckets in ((1, 1 << 20), (2, 1), (9, 1)):
        assert answer(frequent.frequent_pairs(indexed(spark, lists), support, 256, buckets)) == brute_force(lists, support)
    assert min(groups for groups, _ in slices) > 3 and len(met) > 6


@pytest.mark.parametrize(("width", "size"), [(3, 4), (1 << 16, 1 << 20), ((1 << 16) + 1, 7), (1 << 32, 3)])
def test_codes_of_the_widest_groups(width, size, monkeypatch):
    monkeypatch.setattr(frequent, "CHUNK", size)
    kind = np.min_scalar_type(width - 1)
    left, right = np.array([0, width - 1], kind), np.array([0, 1, width - 1], kind)

    def batch(i, j, *rows):
        columns = list(zip(*((i, j, 5, r, 1, np.array(n, np.uint8).tobytes(), held.tobytes(), 3, width) for r, n, held in rows)))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "slice", "right", "wide", "sizes", "held", "groups", "width"])

    def found(*batches):
        return sorted(tuple(map(int, p)) for cell, codes in frequent._codes(iter(batches)) for p in zip(*frequent._names(cell, codes)))

    # Two lists: the first has a left member and two right ones, the second one of each.
    got = found(batch(0, 2, (False, [1, 1], left), (True, [2, 1], right)))
    assert got == sorted([(0, 2), (0, 5), ((width - 1) * 3, (width - 1) * 3 + 2)])
    assert found(batch(1, 1, (False, [3], right))) == sorted([(1, 4), (1, width * 3 - 2), (4, width * 3 - 2)])
    assert found(batch(0, 2, (False, [1, 1], left))) == found(batch(0, 2, (True, [2, 1], right))) == []


def test_shuffle_files_go_with_their_step(spark, lists):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {name for name in files.split("\n") if "/shuffle_" in name}

    index = indexed(spark, lists)
    before = shuffled()
    frequent.frequent_pairs(index, 3, buckets=64)
    for _ in range(50):  # they are removed a little later
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
