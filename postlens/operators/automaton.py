"""Keyword counts with one automaton for the whole dictionary.

The token rules of ``functions/text.py`` make every substring of every length that some word has; the
cost grows with the number of distinct lengths. Here an Aho-Corasick automaton of all words passes over
each text once, whatever their number and lengths, and each hit is checked against the characters next
to it by the rule of its word, so that the counts are those of the token rules:

* words of letters stand between characters that are no ASCII letters;
* numbers, and words of letters and digits with connectors, are not part of a longer one: beyond any
  number of separators that such a run may contain, no further letter or digit follows;
* Han words stand anywhere (occurrences may overlap);
* words of mixed script don't begin or end inside an ASCII word;
* words with symbols or spaces fill whole runs between separators.

Each task counts what it finds, so what is shuffled is bounded by the dictionary, never by the texts'
vocabulary. The words are sent to the tasks once; they are measured first, and a dictionary beyond
``MAX_WORDS`` words or ``MAX_BYTES`` bytes is not sent: its words meet the counted tokens in a join
(:func:`postlens.operators.skills.keyword_counts`), with the same counts.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import ASCII_RULE, HAN_RULE, MIXED_RULE, word_rule
from postlens.operators import skills

# Tasks get these functions with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a dictionary may hold to be sent to the tasks.
MAX_WORDS = 2_000_000
MAX_BYTES = 64 << 20
#: (group, word) counts that a task holds before it hands them on.
HELD_COUNTS = 1 << 18

LETTERS_RULE, NUMBER_RULE = "letters", "number"
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
_DIGITS = frozenset("0123456789")
_ALNUM = _LETTERS | _DIGITS
#: Characters that a number, or a word of letters and digits, may contain between others (fixed rule).
_NUMBER_LINKS = frozenset(",.")
_WORD_LINKS = frozenset("#&+-.@_")
#: Characters that end a run: ASCII white space and list punctuation (fixed rule).
_GAPS = frozenset(" \t\n\v\f\r,;|/()，；、。（）：:")
_NUMBER = re.compile(r"[0-9]+(?:[,.]+[0-9]+)*")

Words = Sequence[tuple[str, str]]


def detailed_rule(word: str, rule: str) -> str:
    """The ASCII rule parted into words of letters, numbers and others."""
    if rule != ASCII_RULE:
        return rule
    if _LETTERS.issuperset(word):
        return LETTERS_RULE
    return NUMBER_RULE if _NUMBER.fullmatch(word) else ASCII_RULE


def _ends(text: str, at: int, step: int, links: frozenset, inner: frozenset) -> bool:
    """Whether no character of ``inner`` follows at ``at`` in direction ``step``, directly or beyond links."""
    size = len(text)
    while 0 <= at < size and text[at] in links:
        at += step
    return not (0 <= at < size and text[at] in inner)


def stands(text: str, begin: int, end: int, rule: str) -> bool:
    """Whether the rule lets a word stand at ``text[begin:end]``, where its characters are."""
    if rule == HAN_RULE:
        return True
    before = text[begin - 1] if begin else ""
    after = text[end] if end < len(text) else ""
    if rule == LETTERS_RULE:
        return before not in _LETTERS and after not in _LETTERS
    if rule == NUMBER_RULE:
        return _ends(text, begin - 1, -1, _NUMBER_LINKS, _DIGITS) and _ends(text, end, 1, _NUMBER_LINKS, _DIGITS)
    if rule == ASCII_RULE:
        return _ends(text, begin - 1, -1, _WORD_LINKS, _ALNUM) and _ends(text, end, 1, _WORD_LINKS, _ALNUM)
    if rule == MIXED_RULE:
        return not (before in _ALNUM and text[begin] in _ALNUM) and not (after in _ALNUM and text[end - 1] in _ALNUM)
    return (not before or before in _GAPS) and (not after or after in _GAPS)


def build(words: Words):
    """The automaton of ``(word, rule)`` pairs, rules as :func:`detailed_rule` gives them."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for word, rule in words:
        made.add_word(word, (word, rule))
    made.make_automaton()
    return made


def occurrences(made, text: str) -> Iterator[str]:
    """The words that stand in a lower-cased text, one for each place."""
    for last, (word, rule) in made.iter(text):
        if stands(text, last + 1 - len(word), last + 1, rule):
            yield word


def _automaton(name: str, words):
    """The automaton of a broadcast dictionary, built once in each Python worker (of the last dictionary that it met)."""
    kept = sys.modules.setdefault("_postlens_automaton", type(sys)("_postlens_automaton")).__dict__
    if kept.get("name") != name:
        kept["name"], kept["made"] = name, build(words.value)
    return kept["made"]


def sent_words(dictionary: DataFrame) -> Words | None:
    """The dictionary's ``(word, rule)`` pairs, or None if it is too large to be sent.

    A word that no rule finds is an error, as everywhere.
    """
    words = dictionary.select("word", word_rule("word").alias("rule"))
    size = words.agg(F.count("word").alias("n"), F.sum(F.octet_length("word")).alias("bytes"), F.min(F.when(F.col("rule").isNull(), F.col("word"))).alias("lost")).first()
    if size["lost"] is not None:
        raise ValueError(f"no token rule finds the dictionary word {size['lost']!r}: it holds separators")
    if size["n"] > MAX_WORDS or (size["bytes"] or 0) > MAX_BYTES:
        return None
    return sorted((r["word"], detailed_rule(r["word"], r["rule"])) for r in words.where(F.col("word").isNotNull()).collect())


def keyword_counts(texts: DataFrame, dictionary: DataFrame, text_col: str = "skills", by: Sequence[str] = ()) -> DataFrame:
    """``by..., token, n`` — occurrences of each dictionary word in ``text_col``, as
    :func:`postlens.operators.skills.keyword_counts` counts them."""
    words = sent_words(dictionary)
    if words is None:
        return skills.keyword_counts(texts, dictionary, text_col, by=by)
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(words)
    name = hashlib.sha256("\n".join(w for w, _ in words).encode()).hexdigest()
    rows = texts.select(F.lower(F.col(text_col)).alias("_text"), *by)  # lower-cased as the token rules do it
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in by]
    groups = len(by)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _automaton(name, sent)
        found: Counter = Counter()
        shape: list[pa.DataType] = []

        def flush() -> pa.RecordBatch:
            keys = list(found)
            columns = [pa.array([k[0][i] for k in keys], shape[i]) for i in range(groups)]
            columns += [pa.array([k[1] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, names=[*by, "token", "n"])

        for batch in batches:
            shape = [batch.column(1 + i).type for i in range(groups)]
            keys = zip(*(batch.column(1 + i).to_pylist() for i in range(groups))) if groups else iter(lambda: (), None)
            for text, key in zip(batch.column(0), keys):
                text = text.as_py()
                if text and made:
                    for word, n in Counter(occurrences(made, text)).items():
                        found[key, word] += n
                if len(found) > HELD_COUNTS:
                    yield flush()
        if found:
            yield flush()

    counted = rows.mapInArrow(count, ", ".join([*kinds, "token string", "n bigint"]))
    return counted.groupBy(*by, "token").agg(F.sum("n").alias("n"))
