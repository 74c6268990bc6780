import random

import numpy as np
import pytest
import regex

from postlens.llm import jaccard, queries
from tests.llm.support import DOCS, ODD, SF, doc, frame, write_tables


def grams(text):
    words = regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(class, links) of every row of (id, text) by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), key), key)
    return sorted((key, least[root(i)], links[i]) for i, (key, _) in enumerate(rows))


def variants(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = words[:]
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 9999)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    texts = list(ODD)
    for k in range(6):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 200))]
        texts += variants(rng, words, 25, 4)
    shared = " ".join(f"p{i}" for i in range(40))  # a passage that many documents share
    texts += [shared + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(60)) for _ in range(60)]
    words = [f"v{rng.randint(0, 400)}" for _ in range(90)]  # cut into sentences anew, three times
    for step in (7, 9, 11):
        texts.append(" ".join(w.capitalize() if i % step == 0 else w + ("." if i % step == step - 1 else "") for i, w in enumerate(words)))
    texts += ["...", "!?"] * 2
    texts += ["one two three", "one  two\nthree", "one two three four five", "copy of it all, many times over"] * 4
    rng.shuffle(texts)
    return [(i + 1, t) for i, t in enumerate(texts)]


def read(df):
    return sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect())


def test_query_equals_brute_force(spark, tmp_path, corpus):
    path = write_tables(spark, tmp_path, documents=([doc(i, t) for i, t in corpus], DOCS))
    assert read(queries.op2_jaccard_join(spark, path)) == brute(corpus)


def test_split_components_give_the_same(spark, corpus):
    df = frame(spark, corpus, "doc_id long, text string")
    assert read(jaccard.jaccard_join(df, task_words=500)) == brute(corpus)


def test_query_on_driver_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert read(queries.op2_jaccard_join(spark, SF)) == brute(rows)


def test_null_ids_repeats_and_clashing_columns(spark):
    text = "a b c d e f g"
    df = frame(spark, [(1, text, 1), (1, text, 1), (None, text, 2), (2, text + " h", 3), (3, None, 4)], "doc_id long, text string, keys int")
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(df).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 1, 1), (None, None, 0), (2, 2, 0), (3, 3, 0)], key=str)
    assert jaccard.one_of_each_class(df).columns == df.columns
    assert jaccard.jaccard_join(frame(spark, [], DOCS)).count() == 0


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.9995), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = jaccard.choose_bands(similarity, recall, 400)
        assert bands * rows <= 400 and 1 - (1 - similarity**rows) ** bands >= recall
    rng = np.random.default_rng(0)
    bands, rows = jaccard.choose_bands(0.8, 0.9995)
    hit = 0
    for _ in range(300):  # pairs of sets at 0.8
        union = rng.integers(0, 1 << 63, 100, dtype=np.int64).astype(np.uint64)
        both = np.concatenate((union[:90], union[10:]))
        keys = jaccard.band_keys(both, np.array([0, 90, 180]), bands, rows)
        hit += (keys[0] == keys[1]).any()
    assert hit == 300


def test_short_and_split_texts():
    hashes, starts, digests, words = jaccard.shingles(["", None, "a", "a b c d", "a b c d e", "x" * 300_000 + " " + "y " * 200_000])
    assert np.diff(starts)[:5].tolist() == [0, 0, 1, 1, 1] and len(set(digests)) == 5
    assert words[5] >= 200_001 and len(np.unique(hashes[starts[5] :])) < 12
