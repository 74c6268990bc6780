import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlens.llm import packing, queries
from tests.llm.support import DOCS, ODD, SF, doc, frame, write_tables

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sequences(rows):
    """The pieces of each sequence, after a check that they fill it without gaps."""
    found = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        filled = found.setdefault(r["sequence_id"], [])
        assert r["offset"] == sum(p["length"] for p in filled) and r["length"] > 0
        filled.append(r)
    assert all(sum(p["length"] for p in s) <= packing.WINDOW for s in found.values())
    return found


def check(rows, docs):
    tokenizer = Tokenizer.from_file(PATH)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert len(pieces) == len(docs)
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(pieces[key], key=lambda r: r["start"]):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and len(part) == r["length"] and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)


def test_query_round_trip(spark, tmp_path):
    rows = [doc(i, t) for i, t in enumerate(ODD + ["word " * 1023, "word " * 1024, "a\nb", "a  b"])]
    out = queries.op4_packing(spark, write_tables(spark, tmp_path, documents=(rows, DOCS))).collect()
    check(out, [(r[0], r[1]) for r in rows])
    sequences(out)


def test_query_on_driver_table_has_little_padding(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op4_packing(spark, SF).collect()
    check(out, docs)
    found = sequences(out)
    assert sum(r["length"] for r in out) / (packing.WINDOW * len(found)) > 0.97


def test_encoder_equals_tokenizer():
    rng = random.Random(2)
    encoder = packing.WordEncoder(PATH)
    alphabet = "ab. ,\n\t\r é漢1'sS!\x1c \x85$ \n abⅷ²́​😀"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ["it's <|endoftext|> x"]
    for text in filter(None, texts):
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(ids, dtype="<u4").tobytes(), text


def test_memory_is_bounded():
    made = []
    memo = packing.Memo(lambda w: made.append(w) or w.encode(), limit=10)
    for k in range(100):
        memo.turn()
        assert memo["kept"] == b"kept" and memo[f"w{k}"] == f"w{k}".encode()
    assert len(memo) + len(memo.old) < 40 and made.count("kept") == 1


@pytest.mark.parametrize("seed", range(5))
def test_differencing(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 50) for _ in range(rng.randint(1, 40))]
    for windows in (1, 2, 3, 7, 50):
        found = packing.difference(sizes, windows)
        assert sorted(p for w in found for p in w) == list(range(len(sizes))) and len(found) <= windows
    many = [rng.randint(1, 50) for _ in range(120)]
    sums = [sum(many[p] for p in w) for w in packing.difference(many, 5)]
    assert max(sums) - min(sums) <= 2


def test_differencing_is_near_the_best_split():
    rng = random.Random(9)
    for _ in range(20):
        sizes = [rng.randint(1, 30) for _ in range(8)]
        best = min(max(sum(s for s, w in zip(sizes, to) if w == k) for k in range(2)) for to in product(range(2), repeat=8))
        assert max(sum(sizes[p] for p in w) for w in packing.difference(sizes, 2)) <= best * 1.2 + 3


def test_windows_rise_when_capacity_is_exceeded():
    assert packing.fitted([], 10) == []
    assert [len(packing.fitted([6] * n, 10)) for n in (1, 2, 3)] == [1, 2, 3]  # by sum alone: 1, 2, 2


def test_full_windows_join_no_group(spark):
    pieces = spark.range(5000).selectExpr("id doc_id", "1024 * id start", "if(id % 1000 = 0, 100, 1024L) length", "cast('ids' as binary) ids")
    out = packing.pack(pieces)
    assert out.columns == ["doc_id", "start", "length", "ids", "sequence_id", "offset"]
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(5000)) and len(sequences(rows)) == 4996
    grouped = [r for r in rows if r["sequence_id"] < packing.FULL]
    assert sorted(r["doc_id"] for r in grouped) == [0, 1000, 2000, 3000, 4000]


def test_repeats_null_ids_and_clashing_columns(spark):
    df = frame(spark, [(1, "a b c", 1), (1, "a b c", 1), (None, "d", 2)], "doc_id long, text string, length int")
    out = packing.pack(packing.token_pieces(df, PATH)).collect()
    assert len(out) == 3 and len(sequences(out)) == 1
    assert packing.pack(packing.token_pieces(frame(spark, [], DOCS), PATH)).count() == 0


def test_both_ways_of_encoding_equal_the_tokenizer():
    import pyarrow as pa

    rng = random.Random(3)
    encoder, tokenizer = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    assert encoder.merges is not None
    pool = [*map(chr, range(0x250)), *map(chr, range(0x4E00, 0x4E20)), *" \n\t'sdmtlverai  " * 20]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(3000)] + [t or "" for t in ODD]
    texts += ["а б", "x y", "<|endoftext|> a", "\U0001f600 ͸"]
    for merges, odd in ((encoder.merges, encoder.odd), (None, "")):
        encoder.merges, encoder.odd = merges, odd
        ids, totals = encoder.encode_all(pa.array(texts))
        assert [p.tolist() for p in np.split(ids, np.cumsum(totals)[:-1])] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_rows_that_repeat_are_dealt_to_many_groups(spark):
    pieces = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.lit(100).cast("long").alias("length"))
    out = packing.pack(pieces)
    per = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.countDistinct("offset").alias("d"), F.count("offset").alias("c")).where("n > 1024 or d <> c")
    assert out.count() == 100_000 and per.count() == 0 and out.select("sequence_id").distinct().count() < 10_200
