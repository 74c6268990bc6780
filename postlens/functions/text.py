"""Tokenisers as native column expressions (``regexp_extract_all`` + higher-order functions).

The reference segments text with a dictionary segmenter whose main dictionary is not part of it,
so its exact output cannot be reproduced. We use two explicit rules instead:

* keyword tokens (for dictionary matching), on lower-cased text:
  - runs of ASCII letters;
  - numbers: digit runs, with ``,`` or ``.`` allowed between digits (``5.7``);
  - mixed runs of letters and digits, which may contain the connectors ``# & + - . @ _`` between
    them, when they are not already a plain letter run or number (``hadoop2``, ``node.js``,
    ``mysql5.7``);
  - for CJK dictionary words, every substring of a Han run whose length equals the length of
    some CJK dictionary word (so occurrences may overlap, as in a fine-grained segmenter);
  - for words of mixed script (``java开发``), every substring of that length, holding both scripts,
    of a run of Han characters, ASCII letters and digits, that does not begin or end inside an ASCII
    word;
  - for words with symbols or spaces (``c++``, ``.net``, ``spring boot``), every run of characters
    other than white space and list punctuation, and as many neighbouring runs of a line as
    the longest such word has, joined by one space.

  So ``hadoop2`` yields ``hadoop2``, ``hadoop`` and ``2``, and ``java`` is not found inside
  ``javascript``. A word is looked for by exactly one of these rules (:func:`word_rule`).
* word tokens (for word counts): on lower-cased text, maximal Han runs and maximal runs of other
  letters and digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = r"[a-z]+"
NUMBER = r"[0-9]+(?:[,.]+[0-9]+)*"
MIXED = r"[a-z0-9]+(?:[#&+\-.@_]+[a-z0-9]+)*"
#: What a text with numbers or mixed runs holds; other texts are searched for letter runs only.
NOT_ONLY_LETTERS = r"[0-9]|[a-z][#&+\-.@_]+[a-z]"
PLAIN_LETTERS = r"^[a-z]+\z"
PLAIN_NUMBER = r"^[0-9]+(?:[.]+[0-9]+)*\z"
HAN_RUN = r"\p{IsHan}+"
WORD = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"
SCRIPT_RUN = r"[a-z0-9\p{IsHan}]+"
#: A run of a list: no white space, no punctuation that separates entries (fixed rule).
LIST_RUN = r"[^\s,;|/()，；、。（）：:]+"
#: What ends a phrase: any separator but a single space.
PHRASE_GAP = r" {2,}|[\t-\r,;|/()，；、。（）：:]"
#: A character that only words with symbols have, and whole words of the ASCII rule.
SYMBOL = r"[^a-z0-9\p{IsHan}]"
ASCII_WORD = r"^(?:[a-z]+|[0-9]+(?:[,.]+[0-9]+)*|[a-z0-9]+(?:[#&+\-.@_]+[a-z0-9]+)*)\z"

ASCII_RULE, HAN_RULE, MIXED_RULE, RUN_RULE = "ascii", "han", "mixed", "run"


def word_rule(word: Column | str) -> Column:
    """The rule that finds a lower-cased dictionary word; NULL for a word that no rule can find."""
    w = _col(word)
    ascii_word = w.rlike(ASCII_WORD)
    return (
        F.when(ascii_word, ASCII_RULE)
        .when(w.rlike(f"^{HAN_RUN}\\z"), HAN_RULE)
        .when(w.rlike(f"^{SCRIPT_RUN}\\z"), MIXED_RULE)
        .when(w.rlike(f"^{LIST_RUN}(?: {LIST_RUN})*\\z"), RUN_RULE)
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def ascii_tokens(text: Column | str) -> Column:
    """Letter runs, numbers and mixed runs of ``lower(text)`` (see the module note)."""
    t = F.lower(_col(text))
    mixed = F.filter(extract_all(t, MIXED), lambda w: ~w.rlike(PLAIN_LETTERS) & ~w.rlike(PLAIN_NUMBER))
    others = F.when(t.rlike(NOT_ONLY_LETTERS), F.concat(extract_all(t, NUMBER), mixed)).otherwise(F.array().cast("array<string>"))
    return F.concat(extract_all(t, LETTERS), others)


def han_grams(text: Column | str, lengths: Iterable[int]) -> Column:
    """All substrings of Han runs of ``text`` with one of the given lengths (overlapping)."""
    # A look ahead takes no characters, so the next one is looked for from the next place.
    out = [F.regexp_extract_all(_col(text), F.lit(rf"(?=(\p{{IsHan}}{{{n}}}))"), 1) for n in sorted({int(x) for x in lengths})]
    if not out:
        return F.array().cast("array<string>")
    return F.concat(*out) if len(out) > 1 else out[0]


def mixed_grams(text: Column | str, lengths: Iterable[int]) -> Column:
    """Substrings of the given lengths of runs of Han characters, ASCII letters and digits that
    hold both scripts and cut no ASCII word in two."""
    # Only runs that hold both scripts are looked into: in other texts this costs one match a run.
    both_scripts = lambda run: run.rlike(r"\p{IsHan}") & run.rlike("[a-z0-9]")
    runs = F.filter(extract_all(F.lower(_col(text)), SCRIPT_RUN), both_scripts)

    def grams_of(n: int):
        def grams(run: Column) -> Column:
            def whole(i: Column) -> Column:
                gram, before, after = F.substr(run, i, F.lit(n)), F.substr(run, i - 1, F.lit(1)), F.substr(run, i + n, F.lit(1))
                begins = (i == 1) | ~(before.rlike("[a-z0-9]") & F.substr(gram, F.lit(1), F.lit(1)).rlike("[a-z0-9]"))
                ends = ~(after.rlike("[a-z0-9]") & F.substr(gram, F.lit(n), F.lit(1)).rlike("[a-z0-9]"))
                both = gram.rlike("[a-z0-9]") & gram.rlike(r"\p{IsHan}")
                return F.when((F.length(gram) == n) & both & begins & ends, gram)

            return F.filter(F.transform(F.sequence(F.lit(1), F.length(run)), lambda i: whole(i)), lambda g: g.isNotNull())

        return grams

    out = [F.flatten(F.transform(runs, grams_of(n))) for n in sorted({int(x) for x in lengths})]
    return F.concat(*out) if out else F.array().cast("array<string>")


def run_grams(text: Column | str, sizes: Iterable[int]) -> Column:
    """Lists of the given numbers of neighbouring runs (a single space between them) of each
    phrase, that is of each stretch of ``text`` that no other separator interrupts."""
    phrases = F.transform(F.split(F.lower(_col(text)), PHRASE_GAP), lambda p: F.split(F.trim(p), " "))

    def grams_of(n: int):
        def grams(runs: Column) -> Column:
            if n == 1:
                return F.filter(runs, lambda w: w.rlike(SYMBOL) & ~w.rlike(ASCII_WORD))
            last = F.size(runs) - n + 1
            joined = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(runs, i, n), " "))
            return F.when(last >= 1, joined).otherwise(F.array().cast("array<string>"))

        return grams

    out = [F.flatten(F.transform(phrases, grams_of(n))) for n in sorted({int(x) for x in sizes})]
    return F.concat(*out) if out else F.array().cast("array<string>")


def keyword_tokens(text: Column | str, needs: Mapping[str, Iterable[int]] | Iterable[int] = ()) -> Column:
    """Tokens to match against a lower-cased keyword dictionary.

    ``needs``: for the rules beyond whole ASCII tokens, the lengths (``han``, ``mixed``) or numbers
    of runs (``run``) of the dictionary's words; a plain list is that of ``han``. Tokens of rules
    that no word needs are not made, and no token is made by two rules, so no occurrence counts
    twice.
    """
    found = {r: list(n) for r, n in (needs.items() if isinstance(needs, Mapping) else {HAN_RULE: needs}.items())}
    parts = [ascii_tokens(text)]
    if found.get(HAN_RULE):
        parts.append(han_grams(text, found[HAN_RULE]))
    if found.get(MIXED_RULE):
        parts.append(mixed_grams(text, found[MIXED_RULE]))
    if found.get(RUN_RULE):
        parts.append(run_grams(text, found[RUN_RULE]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def word_tokens(text: Column | str) -> Column:
    """Word-count tokens of ``lower(text)``: Han runs and runs of other letters/digits."""
    return extract_all(F.lower(_col(text)), WORD)
