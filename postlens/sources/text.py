"""Text sources: posting files, keyword dictionaries, and the streaming posting source.

Postings are read as plain text, not CSV: rows are ragged and a CSV reader would hide short rows
behind NULL columns and treat quotes specially.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import schema
from postlens.functions.parse import postings


Paths = str | list[str] | Mapping[str, str]


def row_keys(path: Paths) -> dict[str, str]:
    """Report row key -> given path (F10): the last name of each path, a directory or pattern too.

    Paths that end in the same name are told apart by as many of their parent folders as it takes;
    a mapping gives the keys itself.
    """
    if isinstance(path, Mapping):
        return dict(path)
    given = list(dict.fromkeys([path] if isinstance(path, str) else path))
    parts = [[p for p in PurePosixPath(g).parts if p != "/"] or [g] for g in given]
    for depth in range(1, max(map(len, parts)) + 1):
        keys = ["/".join(p[-depth:]) for p in parts]
        if len(set(keys)) == len(keys):
            return dict(zip(keys, given))
    return {g: g for g in given}


def file_key(root: str) -> Column:
    """Row key of the input file of a row: its path below ``root``'s folder, decoded.

    Spark gives file paths URL-encoded; ``+`` stands for itself there. Files of the same name in
    different folders keep different keys.
    """
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    decoded = F.url_decode(encoded)
    folder = PurePosixPath(root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:"))
    plain = [p for p in folder.parts if not set(p) & set("*?[{")]
    prefix = str(PurePosixPath(*plain)).rstrip("/") if plain else ""
    below = F.when(F.instr(decoded, prefix + "/") > 0, F.substring_index(decoded, prefix + "/", -1))
    return F.coalesce(below, F.substring_index(decoded, "/", -1))


def read_lines(spark: SparkSession, path: Paths, source: str | None = None, rebalance: bool = False) -> DataFrame:
    """``value STRING`` per line; with ``source``, the row key of the report that the line belongs to.

    ``source="path"``: one report per given path, whatever number of files it holds
    (:func:`row_keys`); ``source="file"``: one per input file (:func:`file_key`).

    ``rebalance=True`` adds Spark's ``rebalance`` hint: AQE cuts the lines into evenly sized
    partitions before the per-row work. Use it when one unsplittable file (gzip) holds a large
    share of the input and would otherwise be parsed by a single task; it costs one shuffle of
    the raw text, so it is off by default (splittable inputs are already balanced by the scan).
    """
    keyed = row_keys(path)
    if source is None:
        df = spark.read.text(list(keyed.values())).select("value")
    else:
        def one(key: str, at: str) -> DataFrame:
            name = F.lit(key) if source == "path" else file_key(at)
            return spark.read.text(at).select("value", name.alias("source"))

        df = reduce(DataFrame.unionByName, [one(key, at) for key, at in keyed.items()])
    return df.hint("rebalance") if rebalance else df


def read_postings(
    spark: SparkSession, path: Paths, sep: str = "|", source: str | None = None, rebalance: bool = False
) -> DataFrame:
    """Typed postings from delimited text files (``id`` is NULL; ``source`` as in :func:`read_lines`)."""
    keep = ("source",) if source else ()
    return postings(read_lines(spark, path, source, rebalance), "value", sep=sep, keep=keep)


def dictionary_name(path: str | None) -> str:
    """Base name before the first dot (``kw.dic`` -> ``kw``); ``bg`` for the bundled list."""
    if not path:
        return schema.DEFAULT_DICTIONARY_NAME
    return PurePosixPath(path.rstrip("/")).name.split(".")[0]


def _clean_words(words: Iterable[str]) -> list[str]:
    out: dict[str, None] = {}
    for w in words:
        w = (w or "").strip().lower()
        if w:
            out[w] = None
    return list(out)


def keyword_dictionary(
    spark: SparkSession,
    path: str | None = None,
    words: Iterable[str] | None = None,
    extra_words: Iterable[str] = (),
) -> DataFrame:
    """``word STRING`` — lower-cased, trimmed, distinct, non-empty.

    Reads one word per line from ``path`` (any Spark-readable location; deduplicated by a
    distributed ``distinct``), or uses the ``words`` parameter list, or the bundled default list;
    ``extra_words`` are added (the user-dictionary option). Parameter lists are cleaned on the
    driver, so they become a plain local relation with no shuffle.
    """
    extra = _clean_words(extra_words)
    if path is None:
        base = words if words is not None else schema.DEFAULT_KEYWORDS
        return spark.createDataFrame([(w,) for w in _clean_words([*base, *extra])], "word string")
    df = spark.read.text(path).select(F.col("value").alias("word"))
    if extra:
        df = df.unionByName(spark.createDataFrame([(w,) for w in extra], "word string"))
    word = F.lower(F.trim(F.col("word")))
    return df.select(word.alias("word")).where(F.col("word") != "").distinct()


def stream_lines(
    spark: SparkSession,
    kind: str,
    options: Mapping[str, str],
    path: str | None = None,
) -> DataFrame:
    """Streaming ``value STRING`` of posting lines.

    ``kind='kafka'``: ``options`` holds ``kafka.bootstrap.servers`` and ``subscribe`` (a
    comma-separated topic list); the message value is cast to a string and the key dropped.
    ``kind='files'``: new text files under ``path``; ``options`` e.g. ``maxFilesPerTrigger``.
    """
    if kind == "kafka":
        reader = spark.readStream.format("kafka")
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if kind == "files":
        if path is None:
            raise ValueError("a file stream needs a path")
        reader = spark.readStream.format("text")
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load(path).select("value")
    raise ValueError(f"unknown stream kind {kind!r}")


def kafka_options(bootstrap: str, topics: str, **extra: str) -> dict[str, str]:
    """Options for a Kafka posting stream; ``topics`` is comma-separated."""
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topics, **extra}


def write_lines(lines: DataFrame, path: str, value_col: str = "line", by: Column | None = None) -> str:
    """Writes one text line per row under ``path`` (overwrite), with the partitions of ``lines``;
    with ``by``, into one folder ``part=<value>`` for each value."""
    rows = lines.select(F.col(value_col).alias("value"), *([by.alias("part")] if by is not None else []))
    writer = rows.write.mode("overwrite")
    (writer.partitionBy("part") if by is not None else writer).text(path)
    return path
