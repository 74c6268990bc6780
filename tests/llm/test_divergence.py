import random
import re

from pyspark.sql import functions as F

from postlens.llm import divergence, queries
from tests.llm.support import DOCS, ODD, doc, frame, write_tables

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=10, top=10):
    """Rows of the audit of (text, lang, source) rows, by summing over every kept term."""
    rows = [tuple(v or "" for v in r) for r in rows]
    out = []
    for lang in {r[1] for r in rows}:
        own = [("".join(c.lower() if "A" <= c <= "Z" else c for c in t), s) for t, g, s in rows if g == lang]
        words = [(TERM.findall(t), s) for t, s in own]
        held = {}
        for found, _ in words:
            for w in set(found):
                held[w] = held.get(w, 0) + 1
        kept = sorted(w for w, n in held.items() if n >= min_docs)

        def shares(source):
            count = {w: 0 for w in kept}
            for found, s in words:
                if source is None or s == source:
                    for w in found:
                        if w in count:
                            count[w] += 1
            total = sum(count.values())
            return count, {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * len(kept)) for w in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        whole = shares(None)[1]
        sources = {s for _, s in words}
        by = {s: shares(s) for s in sources}
        for s in sources:
            pair = [(sum(f(by[s][1][w], by[o][1][w]) for w in kept), o) for o in sources if o != s]
            term = [(f(by[s][1][w], whole[w]), w) for w in kept if by[s][0][w] and by[s][1][w] > whole[w]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def check(spark, rows, **parameters):
    got = divergence.audit(frame(spark, rows, "text string, lang string, source string"), **parameters)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, **parameters)


def words(rng, n):
    pool = [f"w{chr(97 + k)}" for k in range(20)] + ["É", "é", "漢字", "ÀB", "àb", "The", "the", "THE", "K", "😀"]
    return "".join(rng.choice(pool[: 1 + int(rng.random() ** 2 * len(pool))]) + rng.choice(" 1-_[`{\n\x7f") for _ in range(n))


def test_random_documents_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(words(rng, rng.randrange(0, 30)), rng.choice(("en", "fr", None, "")), rng.choice(("a", "b", "c", "é", "Z", None, ""))) for _ in range(260)]
    check(spark, rows)
    check(spark, rows, min_docs=1, top=3)
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    check(spark, rows)


def test_groups_without_terms_and_odd_texts(spark):
    check(spark, [])
    check(spark, [(t, "en", s) for t in ODD for s in ("a", "b")])  # no kept term
    check(spark, [("one two", "en", "a")] * 10 + [("3", "en", "b"), (None, "en", "c"), ("one", "de", "a")])
    check(spark, [("one two two", "en", "a")] * 30)
    check(spark, [("x " * 5000 + "y", "en", "a")] * 9 + [("y " * 200_000, "en", "b")] + [("x y", "en", "b")] * 9)


def test_many_sources_and_shared_paths(spark):
    rng = random.Random(5)
    rows = [(" ".join(f"t{chr(97 + k)}" for k in range(15) if rng.random() < 0.7), "en", f"s{i % 70}") for i in range(700)]
    check(spark, rows)


def test_a_tree_in_parts_gives_the_same_sums(spark, monkeypatch):
    rng = random.Random(6)
    items = [[(s, rng.randrange(1, 4), 1) for s in "abcdef" if rng.random() < 0.6] or [("a", 1, 1)] for _ in range(200)]
    df = frame(spark, [("en", p, 1 + i % 3) for i, p in enumerate(items)], "lang string, path array<struct<source: string, p: bigint, z: bigint>>, rows bigint")

    def sums(parts):
        part = df.repartition(parts, "path").sortWithinPartitions("lang", "path")
        return sorted(tuple(r) for r in divergence.tree_corrections(part).groupBy("lang", "a", "b").agg(F.sum("value")).collect())

    whole = sums(1)
    assert whole == sums(7) == sums(40)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 5)
    assert whole == sums(3)
    for sources in (6, 4, 3, 1):  # handed on early, and paths wider than what a task holds
        monkeypatch.setattr(divergence, "HELD_SOURCES", sources)
        assert whole == sums(3)


def test_query_ignores_other_columns(spark, tmp_path):
    rows = [doc(i, f"alpha beta {'gamma' if i % 2 else ''}", "en", f"s{i % 3}") for i in range(60)]
    got = queries.op11_source_divergence(spark, write_tables(spark, tmp_path, documents=(rows, DOCS))).collect()
    assert sorted(tuple(r) for r in got) == brute([r[1:4] for r in rows])
