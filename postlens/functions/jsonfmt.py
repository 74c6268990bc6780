"""JSON results: key-sorted maps as JSON text in chunks of bounded size, and the doubly encoded
envelope of the stream sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a JSON document, on average; a group with more becomes several documents.
CHUNK_ENTRIES = 10_000


def sorted_map(key: Column | str, value: Column | str) -> Column:
    """Aggregate: ``MAP`` of ``key -> value`` with entries sorted by key (deterministic JSON)."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    entries = F.collect_list(F.struct(k.alias("k"), v.alias("v")))
    return F.map_from_entries(F.sort_array(entries))  # by the struct's first field, the key


def nested_map(key: Column | str, value: Column | str) -> Column:
    """As :func:`sorted_map` for values without an order of their own (maps); few keys."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    entries = F.collect_list(F.struct(k.alias("k"), v.alias("v")))
    by_key = F.array_sort(entries, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    return F.map_from_entries(by_key)


def chunked(counted: DataFrame, groups: Sequence[str], key: str, entries: int = CHUNK_ENTRIES, doubling: bool = False) -> DataFrame:
    """``counted`` with ``chunk``: the number of the document that a row's entry goes to.

    Rows are one per group and key. A group of up to ``entries`` keys is all chunk 0; a larger one
    is dealt by key hash into as many chunks as hold ``entries`` keys each, so that no document,
    and no task that builds one, grows with the number of distinct keys. ``doubling``: into the next
    power of two of chunks (:func:`doubled`), for documents that are kept up while their groups grow.
    """
    # Groups may be constants; tied to the key column they stay the keys of an equi-join.
    none = F.substring(key, 1, 0)
    rows = counted.withColumns({g: F.concat(F.col(g), none) for g in groups})
    sizes = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_keys"))
    number = F.ceil(F.col("_keys") / entries).cast("bigint")
    if doubling:
        bits = F.when(number > 1, F.length(F.bin(number - 1))).otherwise(0)
        number = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
    return rows.join(sizes, list(groups)).withColumn("chunk", chunk_of(key, number)).drop("_keys")


def doubled(keys: int, entries: int = CHUNK_ENTRIES) -> int:
    """Chunks of a group of that many keys with ``doubling``: they change only once the group has doubled."""
    return 1 << max(0, -(-keys // entries) - 1).bit_length()


def chunk_of(key: Column | str, chunks: Column) -> Column:
    return F.pmod(F.xxhash64(key), chunks)


def chunk_name(name: Column, chunk: Column | str = "chunk") -> Column:
    """``name`` for chunk 0, ``name#<chunk>`` for the others."""
    c = F.col(chunk) if isinstance(chunk, str) else chunk
    return F.when(c == 0, name).otherwise(F.concat(name, F.lit("#"), c.cast("string")))


def json_object(key: Column | str, value: Column | str) -> Column:
    """Aggregate: ``{"key": value, ...}`` JSON text of the group, keys in order."""
    return F.to_json(sorted_map(key, value))


def envelope(outer_key: Column | str, inner_json: Column) -> Column:
    """``{"<outer_key>": "<inner_json as a string>"}`` — the inner document is a JSON string."""
    k = F.lit(outer_key) if isinstance(outer_key, str) else outer_key
    return F.to_json(F.create_map(k, inner_json))
