"""One automaton for a whole dictionary: same counts as the token rules, any number and length of words."""

import random
import time

import pytest
from pyspark.sql import functions as F

from postlens.operators import automaton, skills
from postlens.plans import jobs
from postlens.sources.text import keyword_dictionary
from tests.conftest import plan_text
from tests.test_skills import counts, texts

ALPHABET = list("ab1 2.,#+-_&@/|:；，数据算 \t\nA") + ["ß", "İ", "é", "  ", "ab", "数据", "1.2", "c++"]


def words_of(rng, n):
    out = set()
    while len(out) < n:
        w = "".join(rng.choice("ab12.+#-_数据 ,") for _ in range(rng.randrange(1, 5))).strip()
        if w and "  " not in w:
            out.add(w)
    return sorted(out)


def findable(spark, words):
    from postlens.functions.text import word_rule

    df = spark.createDataFrame([(w,) for w in words], "word string")
    return [r["word"] for r in df.where(word_rule("word").isNotNull()).collect()]


def test_counts_are_those_of_the_token_rules(spark):
    rng = random.Random(4)
    words = findable(spark, words_of(rng, 400))
    assert len({automaton.detailed_rule(r["word"], r["rule"]) for r in spark.createDataFrame([(w,) for w in words], "word string").select("word", automaton.word_rule("word").alias("rule")).collect()}) == 6
    df = texts(spark, None, "", *["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 40))) for _ in range(3000)])
    d = keyword_dictionary(spark, words=words)
    got = counts(automaton.keyword_counts(df, d))
    assert got == counts(skills.keyword_counts(df, d)) and len(got) > 100


def test_groups_and_early_hand_over(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice(("x", None, "y")), rng.randrange(3), " ".join(rng.choice(("java", "c++", "数据库", "sql2")) for _ in range(6))) for _ in range(500)]
    df = spark.createDataFrame(rows, "source string, k int, skills string")
    d = keyword_dictionary(spark, words=["java", "c++", "数据", "据库", "sql2", "sql"])
    want = sorted(map(tuple, skills.keyword_counts(df, d, by=("source", "k")).collect()), key=str)
    monkeypatch.setattr(automaton, "HELD_COUNTS", 2)
    assert sorted(map(tuple, automaton.keyword_counts(df, d, by=("source", "k")).collect()), key=str) == want


def test_a_dictionary_beyond_the_bound_is_joined(spark, monkeypatch):
    df, d = texts(spark, "Java c++ 数据库 java"), keyword_dictionary(spark, words=["java", "c++", "数据"])
    sent = automaton.keyword_counts(df, d)
    monkeypatch.setattr(automaton, "MAX_WORDS", 2)
    joined = automaton.keyword_counts(df, d)
    assert "MapInArrow" in plan_text(sent) and "MapInArrow" not in plan_text(joined)
    assert counts(sent) == counts(joined) == {"java": 2, "c++": 1, "数据": 1}


def test_empty_dictionary_and_words_without_a_rule(spark):
    df = texts(spark, "java")
    assert counts(automaton.keyword_counts(df, keyword_dictionary(spark, words=[]))) == {}
    with pytest.raises(ValueError, match="a,b"):
        automaton.keyword_counts(df, keyword_dictionary(spark, words=["ok", "a,b c;d"]))


def test_a_million_words_of_many_lengths(spark):
    words = spark.range(1_000_000).select(F.concat(F.lit("w"), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("word"))
    df = words.where("word like '%a'").select(F.concat_ws(" ", "word", F.lit("wa"), "word").alias("skills")).coalesce(2)
    begun = time.time()
    got = automaton.keyword_counts(df, words).agg(F.count("token"), F.sum("n"), F.max("n")).first()
    assert tuple(got) == (100_000, 300_000, 100_002) and time.time() - begun < 120


def test_long_repetitive_texts_are_linear(spark):
    d = keyword_dictionary(spark, words=["1", "a.b", "of the"])
    df = texts(spark, "1" + "," * 500_000, "a." * 300_000, "of the " * 100_000)
    begun = time.time()
    assert counts(automaton.keyword_counts(df, d)) == {"1": 1, "of the": 100_000} and time.time() - begun < 60


def test_keyword_job_uses_it_for_a_user_dictionary(spark, tmp_path):
    (tmp_path / "in.txt").write_text("|".join(["1", "t", "c", "s", "1-2", "a", "b", "c", "d", "e", "C++ 数据挖掘 java"]) + "\n")
    (tmp_path / "kw.dic").write_text("c++\n据挖\nJava\n")
    cells = jobs.keyword_job(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), dictionary_path=str(tmp_path / "kw.dic"))
    assert [(r["qualifier"], r["value"]) for r in cells.collect()] == [("skill_kw", '{"c++":1,"java":1,"据挖":1}')]
