"""Common owners of member pairs (C6 re-aimed; F14, A13).

Input lists are lines ``"owner m1 m2 ..."``. For a pair of members ``(a, b)`` the answer is the
owners whose list holds both, one row ``(a, b, owner)`` each: a pair of hot members may share a
large part of all owners, so they are never gathered into one value. Counts per pair come from
:func:`pair_counts`.

The reference enumerates every pair inside every list; the number of pairs is quadratic in the
list length, and a hot list would put all of that into one task. Pairs are asked for explicitly, and
answered from an inverted index ``(member, owner)`` in two ways, each for lists of its own:

* a list of up to ``BLOCK`` members is gathered into one row. Its members that some pair asks for as
  ``a`` meet those asked for as ``b``, and a join with the pairs keeps what was asked for: at most
  ``BLOCK`` rows for each listing, however often its members are listed elsewhere;
* longer lists are not enumerated. Each pair is oriented so that ``a`` is the member with fewer of
  them, ``pairs ⋈ index`` on ``a`` gives candidate owners, and a join on ``(b, owner)`` keeps
  those that also list ``b``. A pair's candidates are no more than there are long lists, which are
  at most ``1 / BLOCK`` of all listings.

All joins are plain shuffle joins (AQE splits skewed keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.parse import split_fields
from postlens.session import written

#: Members of a list that is gathered into one row.
BLOCK = 256


def member_lists(lines: DataFrame, value_col: str = "value", sep: str = " ") -> DataFrame:
    """``owner, members ARRAY<STRING>`` from lines ``owner m1 m2 ...`` (split as Java does)."""
    split = lines.select(split_fields(value_col, sep).alias("_p"))
    return split.select(F.get("_p", 0).alias("owner"), F.slice("_p", 2, F.size("_p")).alias("members"))


def membership(lists: DataFrame) -> DataFrame:
    """``member, owner, pos`` — the inverted index (one row per distinct listing; ``pos`` is the
    member's first position in the owner's list)."""
    return (
        lists.select("owner", F.posexplode("members").alias("pos", "member"))
        .groupBy("member", "owner")
        .agg(F.min("pos").alias("pos"))
    )


def owner_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("member").agg(F.count(F.lit(1)).alias("n_owners"))


def common_owner_rows(lists: DataFrame, pairs: DataFrame, ordered: bool = True, salt: int = 1) -> DataFrame:
    """``a, b, owner`` — one row per owner listing both members of a requested pair.

    ``ordered=True`` (the reference's keying: pair ``ab`` comes from lists where ``a`` precedes
    ``b``) keeps owners whose list has ``a`` before ``b``; ``ordered=False`` keeps every owner
    listing both. See ``owners_for_pairs`` for ``salt``.
    """
    return owners_for_pairs(membership(lists), pairs, ordered, salt)


def owners_for_pairs(index: DataFrame, pairs: DataFrame, ordered: bool = False, salt: int = 1, block: int = BLOCK) -> DataFrame:
    """``a, b, owner`` from an inverted index ``member, owner[, pos]`` of distinct listings (``pos``
    needed only when ``ordered``). The index can come from lists or straight from fact rows: only
    lists of up to ``block`` members are ever gathered into one row.

    ``salt > 1`` is for the longer lists: it splits each member's owners into ``salt`` slices (by a hash
    of the owner, so a retried task computes the same slices) and replicates each requested pair once
    per slice. A member listed by a large share of them then spreads over ``salt`` tasks even without
    AQE skew handling.
    """
    if "pos" not in index.columns:
        index = index.withColumn("pos", F.lit(0))
    index = written(index.select("member", "owner", "pos").where("member IS NOT NULL AND owner IS NOT NULL"), "pair-index")
    pairs = written(pairs.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL"), "pairs-asked")
    long = written(index.groupBy("owner").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select("owner"), "pair-long")
    if long.isEmpty():
        return _owners_of_short(index, pairs, ordered)
    short = _owners_of_short(index.join(long, "owner", "left_anti"), pairs, ordered)
    return short.unionByName(_owners_of_long(index.join(long, "owner", "left_semi"), pairs, ordered, salt))


def _owners_of_short(index: DataFrame, pairs: DataFrame, ordered: bool) -> DataFrame:
    """``a, b, owner`` of lists that fit into a row: their members meet within it."""
    asked = pairs.select(F.col("a").alias("member"), F.lit(True).alias("first"), F.lit(False).alias("second"))
    asked = asked.unionByName(pairs.select(F.col("b").alias("member"), F.lit(False).alias("first"), F.lit(True).alias("second")))
    asked = asked.groupBy("member").agg(F.max("first").alias("first"), F.max("second").alias("second"))
    item = F.struct("member", "pos")
    lists = index.join(asked, "member").groupBy("owner").agg(
        F.collect_list(F.when(F.col("first"), item)).alias("firsts"), F.collect_list(F.when(F.col("second"), item)).alias("seconds")
    )
    met = lists.select("owner", "seconds", F.explode("firsts").alias("_a")).select("owner", "_a", F.explode("seconds").alias("_b"))
    if ordered:
        met = met.where(F.col("_a.pos") < F.col("_b.pos"))
    return met.select(F.col("_a.member").alias("a"), F.col("_b.member").alias("b"), "owner").join(pairs, ["a", "b"]).select("a", "b", "owner")


def _owners_of_long(index: DataFrame, pairs: DataFrame, ordered: bool, salt: int) -> DataFrame:
    """``a, b, owner`` by the candidates of each pair's rarer member."""
    counts = owner_counts(index)
    oriented = (
        pairs.select("a", "b")
        .join(counts.select(F.col("member").alias("a"), F.col("n_owners").alias("na")), "a", "left")
        .join(counts.select(F.col("member").alias("b"), F.col("n_owners").alias("nb")), "b", "left")
        .select(
            "a", "b",
            F.when(F.coalesce("na", F.lit(0)) <= F.coalesce("nb", F.lit(0)), F.col("a")).otherwise(F.col("b")).alias("_x"),
            F.when(F.coalesce("na", F.lit(0)) <= F.coalesce("nb", F.lit(0)), F.col("b")).otherwise(F.col("a")).alias("_y"),
        )
    )
    side = index.select(F.col("member").alias("_x"), "owner", F.col("pos").alias("_px"))
    if salt > 1:
        side = side.withColumn("_salt", F.pmod(F.hash("owner"), F.lit(salt)))
        oriented = oriented.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        candidates = oriented.join(side, ["_x", "_salt"]).drop("_salt")
    else:
        candidates = oriented.join(side, "_x")
    if not ordered:
        both = candidates.join(index.select(F.col("member").alias("_y"), "owner"), ["_y", "owner"], "left_semi")
        return both.select("a", "b", "owner")
    both = candidates.join(index.select(F.col("member").alias("_y"), "owner", F.col("pos").alias("_py")), ["_y", "owner"])
    pos_a = F.when(F.col("_x") == F.col("a"), F.col("_px")).otherwise(F.col("_py"))
    pos_b = F.when(F.col("_x") == F.col("a"), F.col("_py")).otherwise(F.col("_px"))
    return both.where(pos_a < pos_b).select("a", "b", "owner")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, n`` — the number of owners of each pair."""
    return rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
