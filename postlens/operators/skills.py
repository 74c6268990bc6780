"""Skill keyword counts (A9, J1) and word counts.

Keyword counting explodes the tokens of each posting and keeps the dictionary's with a left-semi
join. A dictionary whose measured bytes are below the broadcast threshold filters the tokens before
they are counted, so only its words are shuffled. A larger one meets the counted tokens: the join sees
one row per distinct token, and a token that occurs in a third of all postings is one row per task
by then. Both give the same counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import HAN_RULE, MIXED_RULE, RUN_RULE, keyword_tokens, word_rule, word_tokens
from postlens.operators.rank import row_number_within

Needs = Mapping[str, Sequence[int]]


def dictionary_needs(dictionary: DataFrame) -> dict[str, list[int]]:
    """What the dictionary's words ask of the tokenizer: the distinct lengths of its Han words and
    of its words of mixed script, and the distinct numbers of runs of its words with symbols or
    spaces (a handful of integers each, e.g. ``{"han": [2, 4]}``).

    A word that no rule can find is an error, not a silent zero.
    """
    words = dictionary.select("word", word_rule("word").alias("rule"))
    size = F.when(F.col("rule") == RUN_RULE, F.size(F.split("word", " "))).otherwise(F.length("word"))
    kinds = words.groupBy("rule", F.when(F.col("rule").isin(HAN_RULE, MIXED_RULE, RUN_RULE), size).alias("n")).agg(F.min("word").alias("example"))
    needs: dict[str, list[int]] = {}
    for r in kinds.collect():
        if r["rule"] is None:
            raise ValueError(f"no token rule finds the dictionary word {r['example']!r}: it holds separators")
        if r["n"] is not None:
            needs.setdefault(r["rule"], []).append(r["n"])
    return {rule: sorted(n) for rule, n in needs.items()}


#: Bytes that a broadcast word takes beside its own.
WORD_OVERHEAD = 64


def broadcastable(dictionary: DataFrame) -> bool:
    """Whether the dictionary, measured, takes less than the session's broadcast threshold."""
    threshold = dictionary.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if threshold <= 0:
        return False
    size = dictionary.agg(F.sum(F.octet_length("word") + WORD_OVERHEAD).alias("bytes")).first()["bytes"]
    return (size or 0) < threshold


# A tokenizer maps a text column to an ARRAY<STRING> column. The default rules are built-in
# functions; a user segmenter can be plugged in as a vectorised pandas UDF returning a list.
Tokenizer = Callable[[Column], Column]


def tokens(
    postings: DataFrame,
    text_col: str,
    needs: Needs,
    tokenizer: Tokenizer | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep..., token`` rows of the keyword tokens of ``text_col``."""
    toks = tokenizer(F.col(text_col)) if tokenizer else keyword_tokens(text_col, needs)
    return postings.select(*keep, F.explode(toks).alias("token"))


def keyword_counts(
    postings: DataFrame,
    dictionary: DataFrame,
    text_col: str = "skills",
    needs: Needs | None = None,
    tokenizer: Tokenizer | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """``by..., token, n`` — occurrences of each dictionary word in ``text_col``."""
    if needs is None:
        needs = {} if tokenizer is not None else dictionary_needs(dictionary)
    toks = tokens(postings, text_col, needs, tokenizer, keep=by)
    words = dictionary.select(F.col("word").alias("token"))
    if broadcastable(dictionary):
        return toks.join(F.broadcast(words), "token", "left_semi").groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n"))
    counted = toks.groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(words, "token", "left_semi").select(*by, "token", "n")


def without_stop_words(toks: DataFrame, stop: DataFrame | Sequence[str] | None) -> DataFrame:
    """Drops stop words: a fixed list becomes an in-set predicate, a DataFrame an anti join."""
    if stop is None:
        return toks
    if isinstance(stop, DataFrame):
        return toks.join(stop.select(F.col("word").alias("token")), "token", "left_anti")
    return toks.where(~F.col("token").isin(list(stop)))


def word_counts(
    texts: DataFrame, text_col: str, stop: DataFrame | Sequence[str] | None = None, tokenizer: Tokenizer | None = None
) -> DataFrame:
    """``token, n`` — word count of ``text_col`` (stop words removed when given)."""
    toks_col = tokenizer(F.col(text_col)) if tokenizer else word_tokens(text_col)
    toks = texts.select(F.explode(toks_col).alias("token"))
    if isinstance(stop, DataFrame):  # joined after the count, as the dictionary is
        return without_stop_words(toks.groupBy("token").agg(F.count(F.lit(1)).alias("n")), stop)
    return without_stop_words(toks, stop).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def ranked_word_counts(counts: DataFrame) -> DataFrame:
    """``token, n, rnk`` — 1 = most frequent (ties by token), numbered without a single-task sort."""
    return row_number_within(counts, [], [F.col("n").desc(), F.col("token").asc()])
