import random
import zlib

import numpy as np
import pytest

from postlens.llm import langid, quality, queries
from postlens.llm.common import code_points, text_blocks
from tests.llm.support import DOCS, ODD, doc, frame, write_tables

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def held(i, by, rest):
    return zlib.crc32(str(i).encode()) % by == rest


def test_language_query_on_held_out_rows(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op3_language_id(spark, SF).collect()
    assert len(got) == len(docs) and all(r["held_out"] == held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 for r in got)
    right = [r["lang_pred"] == docs[r["doc_id"]] for r in got if r["held_out"]]
    assert sum(right) / len(right) > 0.98


def test_language_of_odd_texts(spark, tmp_path):
    rng = random.Random(1)
    word = {"en": "the of and to in is it that", "fr": "le la les des une est que dans"}
    rows = [doc(i, t, lang=None) for i, t in enumerate(ODD + ["123 456", "!!"])]
    rows += [doc(100 + i, " ".join(rng.choices(word[k].split(), k=12)), lang=k) for i in range(60) for k in [("en", "fr")[i % 2]]]
    rows += [doc(900, "The " * 60_000, lang=None), doc(901, "the of and", lang=None), doc(901, "the of and", lang=None)]
    got = queries.op3_language_id(spark, write_tables(spark, tmp_path, documents=(rows, DOCS))).collect()
    pred = {}
    for r in got:
        pred.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert len(got) == len(rows) and all(len(p) == 1 for p in pred.values())
    for i, t in enumerate(ODD + ["123 456", "!!"]):
        (lang, score), = pred[i]
        assert (lang == "und" and score == 0) == (not any(c.isalpha() for c in t or ""))
    assert {lang for lang, _ in pred[900] | pred[901]} == {"en"}


def test_language_without_anything_to_learn(spark):
    presence = langid.Presence()
    empty = frame(spark, [], DOCS)
    assert langid.fit(presence, empty) is None
    df = frame(spark, [(1, "words", None)], "doc_id long, text string, score int")
    assert [tuple(r) for r in langid.identify(presence, df, None).collect()] == [(1, "und", 0.0)]
    assert langid.identify(presence, empty, None).count() == 0


def test_presence_is_a_blended_spectrum_and_ignores_neighbours():
    presence = langid.Presence()
    alone = [presence.matrix([t])[0][0] for t in ("Abab, 12 ab", "zz", "")]
    together = presence.matrix(["Abab, 12 ab", "zz", ""])[0]
    assert (together == np.array(alone)).all()
    text = " abab ab "
    grams = {text[i : i + n] for n in range(1, langid.GRAMS + 1) for i in range(len(text) - n + 1)}
    assert together[0].sum() == len(grams)
    long = "abcde " * 100_000
    assert (presence.matrix([long])[0] == presence.matrix(["abcde " * 10])[0]).all()


def test_quality_query_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op6_quality_classifier(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    right = [r["predicted"] == labels[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(right) / len(right) > 0.88


def test_quality_of_odd_texts(spark, tmp_path):
    rng = random.Random(4)
    rows = [doc(i, t) for i, t in enumerate(ODD)]
    rows += [doc(100 + i, " ".join(rng.choices(("good plain words here" if i % 2 else "SPAM!! BUY!! NOW!! $$$").split(), k=20))) for i in range(200)]
    labels = [(100 + i, i % 2, 0) for i in range(200)] + [(101, 1, 0), (3, None, 0), (None, 1, 0), (5000, 0, 0)]
    path = write_tables(spark, tmp_path, documents=(rows, DOCS), labels=(labels, LABELS))
    got = {r["doc_id"]: r for r in queries.op6_quality_classifier(spark, path).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([got[100 + i]["predicted"] == i % 2 for i in range(200)]) > 0.97


def test_quality_without_both_classes(spark):
    docs = frame(spark, [doc(1, "a"), doc(1, "a"), doc(2, None)], DOCS)
    assert quality.fit(docs, frame(spark, [(1, 1, 0)], LABELS)) is None
    assert quality.fit(docs, frame(spark, [], LABELS)) is None
    assert [r["score"] for r in quality.score(docs, None).collect()] == [1.0] * 3
    df = frame(spark, [(1, "a", 7)], "doc_id long, text string, score int")
    assert quality.score(df, quality.Model(np.zeros(1 << quality.BITS, dtype=np.float32), 0.0)).collect()[0]["score"] == 0.5


def test_features_stay_within_a_text():
    def found(texts):
        points, starts = code_points(texts)
        return [sorted(b[(p >= lo) & (p < hi)].tolist() for b, p in quality.features(points, starts)) for lo, hi in zip(starts, [*starts[1:], len(points)])]

    assert found(["one two", "three"])[0][0] and [len(x) for x in found(["one two", "three"])] == [4, 4]
    model = quality.Model(np.random.default_rng(0).normal(size=1 << quality.BITS).astype(np.float32), 0.1)
    texts = ["one two", "", "three four five", "six " * 100]
    assert model.scores(texts) == pytest.approx(np.concatenate([model.scores([t]) for t in texts]))


def test_many_languages_and_any_partitioning(spark):
    rng = random.Random(4)
    rows = [doc(i, "".join(rng.choices("abcdefgh ijklm", k=rng.choice((12, 25, 400)))), lang=f"l{i % 1500}") for i in range(3000)]
    df = frame(spark, rows, DOCS)
    presence = langid.Presence()
    model = langid.fit(presence, df)
    assert len(model.languages) > 1000
    one = {tuple(r) for r in langid.identify(presence, df.repartition(1), model).collect()}
    assert one == {tuple(r) for r in langid.identify(presence, df.repartition(13, "text"), model).collect()}


def test_blocks_are_cut_between_words():
    for gap in ("\n", " ", "\t", "\r"):
        text = gap.join(f"w{i}" for i in range(60_000))
        blocks = [s for _, strings in text_blocks([text], limit=1 << 12) for s in strings]
        assert len(blocks) > 50 and sum(len(s.split()) for s in blocks) == 60_000
    assert [s for _, strings in text_blocks(["x" * 9000 + " y"], limit=1 << 12) for s in strings] == ["x" * 9000, " y"]
