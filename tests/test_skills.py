"""Keyword tokens, dictionary semi-join, word counts and stop words."""

import random
import re

from pyspark.sql import functions as F

from postlens import schema
from postlens.functions.text import han_grams, keyword_tokens, word_tokens
from postlens.operators import skills
from postlens.sources.text import dictionary_name, keyword_dictionary
from tests.conftest import final_plan_text, plan_text


def texts(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "skills string")


def counts(df):
    return {r["token"]: r["n"] for r in df.collect()}


def test_java_is_not_found_in_javascript(spark):
    df = texts(spark, "Need javascript and JavaScript", "Java, java")
    got = counts(skills.keyword_counts(df, keyword_dictionary(spark)))
    assert got == {"java": 2}


def test_letters_numbers_and_mixed_tokens(spark):
    row = texts(spark, "Hadoop2 MySQL5.7, node.js c++ 1,000 spark-sql").select(
        keyword_tokens("skills").alias("t")).collect()[0]["t"]
    assert sorted(row) == sorted([
        "hadoop", "mysql", "node", "js", "c", "spark", "sql",   # letter runs
        "2", "5.7", "1,000",                                    # numbers
        "hadoop2", "mysql5.7", "node.js", "spark-sql",          # mixed runs with connectors
    ])


def test_cjk_keywords_overlapping_substrings(spark):
    df = texts(spark, "熟悉数据挖掘及数据分析算法", "算法算法")
    got = counts(skills.keyword_counts(df, keyword_dictionary(spark)))
    assert got == {"数据挖掘": 1, "数据分析": 1, "算法": 3}


def test_words_of_every_script(spark):
    words = ["java开发", "大数据etl", "开发java", "c++", "c#", ".net", "spring boot", "node.js", "数据", "java"]
    d = keyword_dictionary(spark, words=words)
    df = texts(spark, "Java开发 大数据ETL, C++、c#；.NET / Spring Boot,spring  boot", "java开发java", "xjava开发 objc++ Node.js")
    # java: a letter run, so also inside the mixed words; xjava and javascript are other runs
    assert counts(skills.keyword_counts(df, d)) == {
        "java开发": 2, "大数据etl": 1, "开发java": 1, "c++": 1, "c#": 1, ".net": 1, "spring boot": 1, "node.js": 1, "数据": 1, "java": 3}


def test_a_word_that_no_rule_finds_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError, match="a,b"):
        skills.keyword_counts(texts(spark, "a,b"), keyword_dictionary(spark, words=["ok", "a,b c;d"]))


def test_long_texts_do_not_overflow(spark):
    d = keyword_dictionary(spark, words=["of the", "x++"])
    assert counts(skills.keyword_counts(texts(spark, "of the x++ " * 30_000), d)) == {"of the": 30_000, "x++": 30_000}


def test_user_dictionary_and_extension_words(spark):
    d = keyword_dictionary(spark, words=["Spark"], extra_words=schema.EXTENSION_WORDS)
    df = texts(spark, "spark 编程思想 本科以上学历")
    assert counts(skills.keyword_counts(df, d)) == {"spark": 1, "编程思想": 1, "本科以上": 1}


def test_dictionary_name():
    assert dictionary_name(None) == "bg"
    assert dictionary_name("/data/kw.dic") == "kw"
    assert dictionary_name("hdfs:///x/java.web.txt") == "java"


def test_keyword_join_is_broadcast(spark):
    df = texts(spark, "Need Hadoop", "spark")
    plan = final_plan_text(skills.keyword_counts(df, keyword_dictionary(spark)))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_word_tokens_split_han_from_latin(spark):
    row = texts(spark, "Need Hadoop, 熟悉数据挖掘及Linux").select(word_tokens("skills").alias("t")).collect()[0]["t"]
    assert row == ["need", "hadoop", "熟悉数据挖掘及", "linux"]


def test_stop_words_list_and_dataframe(spark):
    df = texts(spark, "the spark and THE hive of 的")
    by_list = counts(skills.word_counts(df, "skills", schema.STOP_WORDS))
    stop_df = keyword_dictionary(spark, words=schema.STOP_WORDS)
    by_df = counts(skills.word_counts(df, "skills", stop_df))
    assert by_list == by_df == {"spark": 1, "hive": 1}


def test_ranked_word_counts(spark):
    df = texts(spark, "b a b c b a")
    got = {r["token"]: (r["n"], r["rnk"]) for r in skills.ranked_word_counts(skills.word_counts(df, "skills")).collect()}
    assert got == {"b": (3, 1), "a": (2, 2), "c": (1, 3)}


def test_word_count_save_sorted(spark, tmp_path):
    from postlens.plans.report import save_word_count

    df = texts(spark, "b a b c b a")
    out = str(tmp_path / "wc")
    save_word_count(skills.word_counts(df, "skills"), out)
    import glob

    lines = []
    for f in sorted(glob.glob(out + "/part-*")):
        lines += open(f, encoding="utf-8").read().splitlines()
    assert lines == ["(b,3)", "(a,2)", "(c,1)"]


def test_no_udf_on_tokenising(spark):
    df = texts(spark, "x").select(F.explode(keyword_tokens("skills", [2, 4])))
    plan = final_plan_text(df)
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_pluggable_pandas_tokenizer(spark):
    import pandas as pd

    @F.pandas_udf("array<string>")
    def whitespace(s: pd.Series) -> pd.Series:
        return s.str.lower().str.split()

    df = texts(spark, "Spark HIVE spark", "hive")
    got = counts(skills.keyword_counts(df, keyword_dictionary(spark), tokenizer=whitespace))
    assert got == {"spark": 2, "hive": 2}


def test_tokens_of_texts_with_and_without_numbers_and_of_overlapping_han_runs(spark):
    rng = random.Random(11)
    parts = ["java", "Hive", "5", "7.1", "x2", "c-d", "e_f", "+", "-", ".", "@", "算法", "数据挖掘及", "\U00020000法\U00020001", " ", ",", "、", ""]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 9))) for _ in range(500)] + [None, "", "a.b", "a. b", "算"]

    def brute(t):
        low = t.lower()
        mixed = [w for w in re.findall(r"[a-z0-9]+(?:[#&+\-.@_]+[a-z0-9]+)*", low) if not re.fullmatch(r"[a-z]+|[0-9]+(?:[.]+[0-9]+)*", w)]
        runs = re.findall("[\u4e00-\u9fff\U00020000\U00020001]+", t)
        grams = [run[at : at + n] for n in (1, 2, 4) for run in runs for at in range(len(run) - n + 1)]
        return re.findall(r"[a-z]+", low) + re.findall(r"[0-9]+(?:[,.]+[0-9]+)*", low) + mixed + grams

    df = spark.createDataFrame([(r,) for r in rows], "skills string").select("skills", keyword_tokens("skills", {"han": [4, 1, 2]}).alias("t"))
    for r in df.collect():
        assert r["t"] == (None if r["skills"] is None else brute(r["skills"]))
    assert "lambdafunction" not in plan_text(spark.createDataFrame([("a",)], "t string").select(han_grams("t", [2, 4])))
