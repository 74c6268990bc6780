"""Line deduplication (DataFrame operations only).

The lines of every text are exploded and normalised to keys; of the keys long enough to count, only a
128-bit hash travels. Distinct (hash, document) pairs are counted per hash, with map-side aggregation,
so a line that a third of all documents hold is one row per task before the second shuffle. Keys in at
least ``min_docs`` documents are dropped everywhere but in the largest id that holds them: each row's
dropped positions are gathered (never more than the text has lines), joined back to it, and what lies
between them is put together by position.

A dropped key that is *hot* (its lines number more than ``1 / HOT_SHARE`` of all lines, so there are
fewer than ``HOT_SHARE`` such keys, whatever the data) is found by a broadcast of those keys; only the others
meet their lines through a shuffle, where no key has more rows than that share.

Results for odd input: a null text counts as empty, and an empty text is one empty line. Rows with the same
id are one document: its key counts once, and all of them keep their lines where that id is the
largest. Rows without an id are one document together, smaller than all others. A line repeated
within its document counts once but each of its lines is dropped. An empty table gives an empty
result. Input columns may have any name; those that the operator adds replace columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import cut, text_or_empty

#: Characters stripped at both ends of a line.
STRIPPED = " \t\n\v\f\r"
MIN_CHARS = 20
MIN_DOCS = 3
HOT_SHARE = 4096
#: Sets the second half of a key's hash apart from the first.
SEED = 12
ADDED = ("n_lines", "n_dropped")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A to Z in lower case."""
    stripped = F.btrim(line, F.lit(STRIPPED))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)  # there, lower() changes A to Z alone and is faster
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, _UPPER, _LOWER))


def key_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(_id, _text, _pos, _h1, _h2): the lines whose key is long enough, by hashes of text and key."""
    text = text_or_empty(f"`{text_col}`")
    lines = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_text"), F.posexplode(lines_of(text)).alias("_pos", "_line"))
    # A line has at least as many bytes as its key has characters: short ones go before any other work.
    keyed = lines.where(F.octet_length("_line") >= min_chars).select("_id", "_text", "_pos", line_key(F.col("_line")).alias("_key"))
    long = keyed.where(F.char_length("_key") >= min_chars)
    return long.select("_id", "_text", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(SEED), F.col("_key")).alias("_h2"))


def dropped_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(_id, _text, _pos) of the lines that go."""
    holders = lines.select("_h1", "_h2", "_id").distinct()
    repeated = holders.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keeper")).where(F.col("_docs") >= min_docs)
    repeated = cut(repeated.drop("_docs"), "lines-repeated")
    numbers = lines.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    share = max(1, lines.count() // HOT_SHARE)
    hot = cut(repeated.join(numbers.where(F.col("_n") > share).drop("_n"), ["_h1", "_h2"]), "lines-hot")
    seen = lines.join(F.broadcast(hot.withColumnRenamed("_keeper", "_hot")), ["_h1", "_h2"], "left")
    goes = ~F.col("_id").eqNullSafe(F.col("_keeper"))
    columns = ["_id", "_text", "_pos"]
    of_hot = seen.where(F.col("_hot").isNotNull()).withColumnRenamed("_hot", "_keeper").where(goes)
    of_rest = seen.where(F.col("_hot").isNull()).drop("_hot").join(repeated, ["_h1", "_h2"]).where(goes)
    return of_hot.select(columns).unionByName(of_rest.select(columns))


def without_positions(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the ascending positions ``gone`` (0-based): the stretches between them."""

    def stretch(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(gone, i - 1) + 1)
        end = F.coalesce(F.get(gone, i), F.size(lines))
        return F.slice(lines, begin + 1, end - begin)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``docs`` with its repeated lines dropped from the text, ``n_lines`` (before) and ``n_dropped``."""
    lines = cut(key_lines(docs, id_col, text_col, min_chars), "lines")
    gone = (
        dropped_lines(lines, min_docs)
        .groupBy("_id", "_text")
        .agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
        .withColumnsRenamed({"_id": "_gone_id", "_text": "_gone_text"})
    )
    names = [c for c in docs.columns if c not in ADDED]
    text = text_or_empty(f"`{text_col}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in names]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), text.alias("_whole"), F.xxhash64(text).alias("_text")
    )
    joined = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_text") == F.col("_gone_text")), "left")
    # The lines are bound once, as the one element of an array; a text that keeps all of them isn't split.
    left = F.get(F.transform(F.array(lines_of(F.col("_whole"))), lambda all_lines: F.array_join(without_positions(all_lines, F.col("_gone")), "\n")), F.lit(0))
    breaks = F.octet_length("_whole") - F.octet_length(F.replace(F.col("_whole"), F.lit("\n"), F.lit("")))
    out = {c: F.col("_row")[c] for c in names} | {text_col: F.when(F.col("_gone").isNull(), F.col("_whole")).otherwise(left)}
    return joined.select(
        *[c.alias(n) for n, c in out.items()], (breaks + 1).cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped")
    )
