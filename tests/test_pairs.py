"""Common owners of member pairs, without enumerating pairs inside lists, against brute force."""

import random

from postlens.operators import pairs
from postlens.operators.pairs import common_owner_rows, member_lists, pair_counts


def brute_force(lists, ordered=True):
    """(a, b) -> owners whose list holds a before b (or both, in any order)."""
    out = {}
    for line in lists:
        owner, *members = line.split(" ")
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                out.setdefault((a, b), set()).add(owner)
                if not ordered:
                    out.setdefault((b, a), set()).add(owner)
    return out


def answer(rows):
    out = {}
    for r in rows.collect():
        out.setdefault((r["a"], r["b"]), set()).add(r["owner"])
    return out


def test_small_lists(spark):
    lists = ["team1 kim lee max", "team2 max kim", "team3 lee max kim ann", "team4 ann"]
    df = member_lists(spark.createDataFrame([(x,) for x in lists], "value string"))
    names = ["kim", "lee", "max", "ann", "nobody"]
    pairs = spark.createDataFrame([(a, b) for a in names for b in names if a != b], "a string, b string")
    assert answer(common_owner_rows(df, pairs)) == brute_force(lists)
    rows = common_owner_rows(df, pairs, ordered=False)
    assert answer(rows) == brute_force(lists, ordered=False)
    assert {(r["a"], r["b"]): r["n"] for r in pair_counts(rows).collect()} == {p: len(o) for p, o in brute_force(lists, ordered=False).items()}


def test_order_of_members(spark):
    lists = member_lists(spark.createDataFrame([("o1 A B",), ("o2 B A",), ("o3 A",)], "value string"))
    pairs = spark.createDataFrame([("A", "B")], "a string, b string")
    assert answer(common_owner_rows(lists, pairs)) == {("A", "B"): {"o1"}}
    assert answer(common_owner_rows(lists, pairs, ordered=False)) == {("A", "B"): {"o1", "o2"}}


def test_rows_form_matches_brute_force_on_random_lists(spark):
    rnd = random.Random(3)
    members = [f"m{i}" for i in range(12)]
    lists = []
    for o in range(40):
        ms = rnd.sample(members, rnd.randint(1, 8))
        lists.append(" ".join([f"o{o:02d}", *ms]))
    lists_df = member_lists(spark.createDataFrame([(x,) for x in lists], "value string"))
    pairs = [(a, b) for a in members for b in members if a < b]
    got = {}
    for r in common_owner_rows(lists_df, spark.createDataFrame(pairs, "a string, b string"), ordered=False).collect():
        got.setdefault((r["a"], r["b"]), set()).add(r["owner"])
    want = {}
    for line in lists:
        owner, *ms = line.split(" ")
        s = set(ms)
        for a, b in pairs:
            if a in s and b in s:
                want.setdefault((a, b), set()).add(owner)
    assert got == want


def test_ordered_rows_match_brute_force(spark):
    rnd = random.Random(9)
    members = [f"m{i}" for i in range(10)]
    lists = [" ".join([f"o{o:02d}", *rnd.sample(members, rnd.randint(1, 7))]) for o in range(30)]
    lists_df = member_lists(spark.createDataFrame([(x,) for x in lists], "value string"))
    pairs = [(a, b) for a in members for b in members if a != b]
    got = {}
    for r in common_owner_rows(lists_df, spark.createDataFrame(pairs, "a string, b string")).collect():
        got.setdefault((r["a"], r["b"]), set()).add(r["owner"])
    want = {}
    for line in lists:
        owner, *ms = line.split(" ")
        for i in range(len(ms)):
            for j in range(i + 1, len(ms)):
                want.setdefault((ms[i], ms[j]), set()).add(owner)
    assert got == want


def test_salted_lookup_equals_unsalted_with_a_hot_member(spark):
    lists = [f"o{i:03d} HOT m{i % 7} m{(i * 3) % 11}" for i in range(300)] + ["x HOT m1"]
    lists_df = member_lists(spark.createDataFrame([(x,) for x in lists], "value string"))
    pairs = spark.createDataFrame([("HOT", f"m{i}") for i in range(11)] + [("m1", "HOT")], "a string, b string")
    plain = sorted(map(tuple, common_owner_rows(lists_df, pairs).collect()))
    salted = sorted(map(tuple, common_owner_rows(lists_df, pairs, salt=8).collect()))
    assert plain == salted and len({r[:2] for r in plain}) == 11


def test_pairs_of_hot_members_make_no_more_candidates_than_short_lists_hold(spark, monkeypatch):
    lists = [f"o{i:03d} A B" if i % 2 else f"o{i:03d} {'A' if i % 4 else 'B'} m{i % 7}" for i in range(400)]
    lists += [f"long{i} " + " ".join(["A", *(f"x{k}" for k in range(6)), "B"][:: 1 if i % 2 else -1]) for i in range(9)]
    df = member_lists(spark.createDataFrame([(x,) for x in lists], "value string"))
    asked = spark.createDataFrame([("A", "B"), ("B", "x3"), ("m1", "A"), ("A", "A"), (None, "A")], "a string, b string")
    index = pairs.membership(df)
    seen, before = [], pairs._owners_of_long
    monkeypatch.setattr(pairs, "_owners_of_long", lambda i, *rest: seen.append(i.select("owner").distinct().count()) or before(i, *rest))
    for ordered in (True, False):
        want = {}
        for p in (("A", "B"), ("B", "x3"), ("m1", "A"), ("A", "A")):
            holds = {o for o, *ms in map(str.split, lists) if set(p) <= set(ms) and (not ordered or ms.index(p[0]) < ms.index(p[1]))}
            want |= {p: holds} if holds else {}
        for block in (1, 4, 256):
            assert answer(pairs.owners_for_pairs(index, asked, ordered, 2, block)) == want
    assert seen == [409, 9, 409, 9]  # only lists beyond the block are asked for candidates
