import random

import numpy as np
import pytest

from postlens.llm import queries, topk
from tests.llm.support import SF, frame, write_tables

CODES = "id long, code long"


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute(codes, asked, k):
    out = []
    for q, c in asked:
        near = sorted(((c ^ d) & ((1 << 64) - 1)).bit_count() * (1 << 40) + i for i, d in codes)[:k]
        out += [(q, rank + 1, n % (1 << 40), n >> 40) for rank, n in enumerate(near)]
    return sorted(out)


def read(df, name="id"):
    return sorted((r["query_id"], r["rank"], r[name], r["distance"]) for r in df.collect())


@pytest.mark.parametrize("kind", ["random", "clustered", "equal", "few"])
def test_search_is_exact(spark, kind):
    rng = random.Random(kind)
    centres = [rng.getrandbits(64) for _ in range(5)]
    make = {
        "random": lambda: rng.getrandbits(64),
        "clustered": lambda: rng.choice(centres) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)),
        "equal": lambda: 0xF0F0F0F0F0F0F0F0 if rng.random() < 0.8 else rng.getrandbits(64),
        "few": lambda: rng.getrandbits(64),
    }[kind]
    codes = [(i, signed(make())) for i in range(4 if kind == "few" else 3000)]
    asked = codes[::50]
    got = read(topk.search(frame(spark, codes, CODES), frame(spark, asked, CODES), 10))
    assert got == brute(codes, asked, 10)


@pytest.mark.parametrize("n", [11, 300, 5000])
def test_block_is_exact_for_any_bound(n):
    rng = np.random.default_rng(n)
    codes, asked = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 1 << 63, 40).astype(np.uint64)
    bounds = rng.integers(5, 65, 40)
    query, code, apart = topk.Block(codes).nearest(asked, bounds, 3)
    for q in range(40):
        every = np.bitwise_count(codes ^ asked[q]).astype(int)
        limit = min(bounds[q], np.sort(every)[2])
        assert sorted(zip(code[query == q], apart[query == q])) == [(i, d) for i, d in enumerate(every) if d <= limit]


def test_hot_codes_hold_k_hits_a_query(spark, monkeypatch):
    hot = 0x0F0F0F0F0F0F0F0F
    codes = [(i, signed(hot if i % 3 else hot ^ (1 << i % 64))) for i in range(6000)]  # 4,000 equal, the others one bit off
    assert topk.first_copies(frame(spark, codes, CODES), 10).count() == 650
    assert sorted(r[0] for r in topk.first_copies(frame(spark, codes, CODES), 10).where(f"code = {hot}").collect()) == [i for i, c in codes if c == hot][:10]
    assert read(topk.search(frame(spark, codes, CODES), frame(spark, codes[::7], CODES), 10)) == brute(codes, codes[::7], 10)
    # Within a block too, however many codes are equally near: ranked by place, held in steps.
    monkeypatch.setattr(topk, "STEP", 1 << 10)
    near = np.array([hot ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)], dtype=np.uint64)
    query, code, apart = topk.Block(near).nearest(np.full(500, hot, dtype=np.uint64), np.full(500, 64), 10, ties=False)
    assert query.tolist() == np.repeat(np.arange(500), 10).tolist() and code.tolist() == [*range(10)] * 500 and set(apart.tolist()) == {2}


def test_odd_vectors(spark, tmp_path):
    rows = [(0, [1.0, -1.0, None, float("nan")], 1), (50, [1.0, -1.0, 0.0, 5.0], 1), (100, None, 1), (150, [], 1), (7, [1.0] * 70, None)]
    path = write_tables(spark, tmp_path, embeddings=(rows, "vec_id long, embedding array<float>, label int"))
    got = queries.op1_topk_search(spark, path).collect()
    assert {r["query_id"] for r in got} == {0, 50, 150} and len(got) == 12
    empty = frame(spark, [], CODES)
    assert topk.search(empty, empty, 3).count() == 0


def test_query_on_driver_table(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    codes = [(i, signed(sum((x > 0) << b for b, x in enumerate(v)))) for i, v in vectors.items()]
    assert read(queries.op1_topk_search(spark, SF), "vec_id") == brute(codes, [c for c in codes if c[0] % 50 == 0], 10)
