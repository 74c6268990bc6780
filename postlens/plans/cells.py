"""Building blocks shared by the batch report and the streaming report.

Both turn each posting into counted cells — salary buckets, dimension values, keyword tokens —
and count them with a single aggregate. The pieces here keep that plan lean:

* ``with_bucket_labels`` stages the salary expressions in separate projections (value, lower
  edge, label), so each is evaluated once per row;
* ``explode_cells`` emits the fixed cells and the tokens with one ``posexplode`` over a plain
  string array (a generator that stays in whole-stage codegen) and looks the cell's tags up by
  position;
* ``keep_dictionary_tokens`` keeps the token cells that are dictionary words, before they are counted:
  in batch for a dictionary that may be broadcast, in streams (before the state) for any. A large one
  is shuffled in a stream; then tokens are salted so that a hot one spreads, and so are the other
  cells, which match nothing;
* ``keep_dictionary_counts`` (batch, a large dictionary) keeps the counted token cells that are
  dictionary words: only distinct tokens meet the dictionary, and the other cells never do; both
  branches read the same aggregate (one scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.salary import bucket_hi, bucket_label, bucket_lo, keep_bucket, salary_part


def empty_tokens() -> Column:
    return F.array().cast("array<string>")


def with_bucket_labels(df: DataFrame, grid: Sequence[int], drop_zero_floor: bool, carry: Sequence[str]) -> DataFrame:
    """``carry..., _b0, _b1`` — the reported bucket label of the floor / ceiling side of
    ``salary`` (NULL when the side has no bucket or the bucket is not reported)."""
    start, end, step = grid
    vals = df.select(*carry, *[salary_part("salary", s).alias(f"_v{s}") for s in (0, 1)])
    los = vals.select(*carry, *[bucket_lo(F.col(f"_v{s}"), start, end, step).alias(f"_lo{s}") for s in (0, 1)])
    labels = []
    for s in (0, 1):
        lo = F.col(f"_lo{s}")
        hi = bucket_hi(lo, end, step)
        labels.append(F.when(keep_bucket(lo, hi, drop_zero_floor), bucket_label(lo, hi)).alias(f"_b{s}"))
    return los.select(*carry, *labels)


def explode_cells(
    df: DataFrame,
    tag_names: Sequence[str],
    fixed: Sequence[tuple[Sequence[str], Column]],
    tokens: Column | None = None,
    token_tags: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep..., <tag_names>..., key`` — one row per non-NULL cell.

    ``fixed`` lists ``(tag values, key column)`` for the cells every row has (the key is NULL
    when the row does not count that cell); ``tokens`` is an ``ARRAY<STRING>`` of further keys,
    all tagged ``token_tags``.
    """
    parts = [F.array(*[key for _, key in fixed])] if fixed else []
    if tokens is not None:
        parts.append(F.coalesce(tokens, empty_tokens()))
    keys = F.concat(*parts) if len(parts) > 1 else parts[0]
    pos = F.col("_pos")
    tags = []
    for i, name in enumerate(tag_names):
        by_position = F.get(F.array(*[F.lit(t[i]) for t, _ in fixed]), pos) if fixed else F.lit(None)
        default = F.lit(token_tags[i]) if tokens is not None else F.lit(None).cast("string")
        tags.append(F.coalesce(by_position, default).alias(name))
    return (
        df.select(*keep, F.posexplode(keys).alias("_pos", "key"))
        .where(F.col("key").isNotNull())
        .select(*keep, *tags, "key")
    )


#: Slices that a hot token or cell is dealt into before a shuffle join with the dictionary (streams).
TOKEN_SLICES = 8


def keep_dictionary_counts(counted: DataFrame, dictionary: DataFrame, tag: str, token_tag: str, columns: Sequence[str]) -> DataFrame:
    """Drops counted rows tagged ``token_tag`` whose key is not a dictionary word; others pass.

    The rows are split above a generator, below which Catalyst pushes no filter: both branches
    keep the same aggregate underneath, so its exchange is computed once and reused.
    """
    kind = F.explode(F.array(F.col(tag) == token_tag)).alias("_token")
    split = counted.select(*columns, kind)
    words = dictionary.select(F.col("word").alias("_dw"))
    kept = split.where(F.col("_token")).join(words, F.col("key") == F.col("_dw"), "left_semi")
    return split.where(~F.col("_token")).unionByName(kept).select(*columns)


def keep_dictionary_tokens(
    rows: DataFrame, dictionary: DataFrame, tag: str, token_tag: str, columns: Sequence[str], small: bool
) -> DataFrame:
    """Drops rows tagged ``token_tag`` whose key is not a dictionary word; other rows pass.

    ``small`` says that the dictionary was measured and may be broadcast.
    """
    is_token = F.col(tag) == token_tag
    words = dictionary.select(F.col("word").alias("_dw"))
    if small:
        joined = rows.join(F.broadcast(words), is_token & (F.col("key") == F.col("_dw")), "left")
    else:
        # Any slice finds the word; its counts are the same. Other cells get slices that no word has.
        spread = F.floor(F.rand(7) * TOKEN_SLICES).cast("int")
        salted = rows.withColumn("_spread", spread).withColumn("_slice", F.when(is_token, F.col("_spread")).otherwise(-1 - F.col("_spread")))
        sliced = words.select("_dw", F.explode(F.sequence(F.lit(0), F.lit(TOKEN_SLICES - 1))).alias("_ds"))
        joined = salted.join(sliced, (F.col("key") == F.col("_dw")) & (F.col("_slice") == F.col("_ds")), "left")
    return joined.where(~is_token | F.col("_dw").isNotNull()).select(*columns)
