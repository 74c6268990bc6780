"""Conversation structure repair by iterative-deepening A*.

A conversation's rows, in order of turn, are edited so that their roles' initials read ``(s?(ua)+)?``:
Delete costs 2 (blank and duplicate rows must go), Insert of an empty user or assistant turn 5, Keep 0,
Rerole to user or assistant 1; a truncated row that isn't deleted costs 5 more. Of the cheapest edits
the ASCII-least sequence of initials (D, I, K, R) is the answer.

The search goes depth first through the edits in ASCII order, under a cost bound that grows until a
path is accepted; a table of failed states keeps the largest rest of the bound that was in vain. As no
insertion stands after the last row, paths over the same rows never extend one another, so their
order is decided within them. That lets a conversation be searched in *segments* of at most ``SEGMENT``
rows each, spread over the cluster, from every state to every state (start, after s, after u, after
a). A pass over a conversation's segments then adds up their costs, four sums at a time, compares equal
ones by the order of their paths so far, and walks back along the choices. A conversation of any length
thus costs one task some numbers per ``SEGMENT`` rows; what remains sequential is its digest, which
streams through a task.

Rows are sorted by range of (conversation, turn), so a hot conversation spans many tasks; a duplicate is
found by the first place of each (conversation, hash of role and text), a set of places and not a join
on a hot value.

Results for odd input: rows without a turn come first; rows of the same turn are ordered by a hash of
role and text, equal ones being neighbours; a null role or text counts as one space; rows without a
conversation id are one conversation. A row with any other role, an empty one too, can only be deleted or reroled. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import cut, per_worker

#: Rows that one search takes, at most.
SEGMENT = 64
STRIPPED = " \t\n\v\f\r"
COST = {"D": 2, "I": 5, "K": 0, "R": 1}
TRUNCATED_COST = 5

START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state that a user or assistant turn leads to from each state.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NEW_ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
#: What completes a conversation after its last row in each state.
TAIL = ("", "II", "I", "")
_NEVER = 1 << 60
#: Segments whose searches a worker remembers.
REMEMBERED = 1 << 16


# A row's symbol is x if it must go, else its initial's class: s, u, a or o; in upper case if truncated.


def kept_state(symbol: str, state: int) -> int | None:
    """The state after keeping a row, or None where its role doesn't fit."""
    kind = symbol.lower()
    if kind == "s":
        return AFTER_S if state == START else None
    return NEXT[state] if kind == ("a" if state == AFTER_U else "u") else None


class Search:
    """Searches over one segment towards one state; failed states are shared by all that it starts from."""

    def __init__(self, symbols: str, goal: int) -> None:
        self.symbols, self.goal = symbols, goal
        self.failed: dict[tuple[int, int], int] = {}
        least = {"x": 2, "s": 1, "o": 1, "u": 0, "a": 0}
        self.rest, self.leads = [0], [False]  # what the rows from i on cost at least; whether one of them can lead
        for c in reversed(symbols):
            self.rest.append(self.rest[-1] + (least[c] if c.islower() else COST["D"]))
            self.leads.append(self.leads[-1] or c in "sS")
        self.rest.reverse()
        self.leads.reverse()

    def reachable(self, state: int) -> bool:
        if self.goal == START:
            return state == START
        return self.goal != AFTER_S or state == AFTER_S or (state == START and self.leads[0])

    def at_least(self, i: int, state: int) -> int:
        """A lower bound of the cost from row i on."""
        left = len(self.symbols) - i
        if self.goal in (START, AFTER_S):  # all rows go but the one that leads; no way back from other states
            return COST["D"] * max(0, left - (state != self.goal)) if state <= self.goal else _NEVER
        return max(0, self.rest[i] - 1) if state == START and self.leads[i] else self.rest[i]

    def within(self, i: int, state: int, budget: int) -> str | None:
        """The first path from row i on that costs no more than the budget."""
        if i == len(self.symbols):
            return "" if state == self.goal else None
        if self.at_least(i, state) > budget or self.failed.get((i, state), -1) >= budget:
            return None
        symbol = self.symbols[i]
        extra = TRUNCATED_COST if symbol.isupper() else 0
        steps = [("D", i + 1, state, COST["D"]), ("I", i, NEXT[state], COST["I"])]
        if symbol != "x":
            kept = kept_state(symbol, state)
            if kept is not None:
                steps.append(("K", i + 1, kept, COST["K"] + extra))
            steps.append(("R", i + 1, NEXT[state], COST["R"] + extra))
        for edit, then, to, cost in steps:
            if cost <= budget:
                found = self.within(then, to, budget - cost)
                if found is not None:
                    return edit + found
        self.failed[i, state] = budget
        return None

    def cheapest(self, state: int) -> tuple[int, str]:
        bound = self.at_least(0, state)
        while True:
            path = self.within(0, state, bound)
            if path is not None:
                return bound, path
            bound += 1


def segment_choices(symbols: str) -> list[dict]:
    """The cheapest edits of a segment from each state to each that can be reached."""
    out = []
    for goal in range(4):
        search = Search(symbols, goal)
        for state in range(4):
            if search.reachable(state):
                cost, path = search.cheapest(state)
                out.append({"entry": state, "exit": goal, "cost": cost, "path": path})
    return out


def edited_rows(symbols: str, entry: int, path: str) -> list[dict]:
    """What a path does: for each edit its row in the segment (the next one, for an insertion) and the role that it gives."""
    out, at, state = [], 0, entry
    for edit in path:
        role = None
        if edit in "IR":
            state = NEXT[state]
            role = NEW_ROLE[state]
        elif edit == "K":
            state = kept_state(symbols[at], state)
        out.append({"row": min(at, len(symbols) - 1), "edit": edit, "role": role})
        at += edit != "I"
    return out


def ordered_turns(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(key, place, turn, role, text): rows by conversation and turn; ``place`` ascends in that order. Written once."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    named = rows.select(conversation_key(id_col).alias("key"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    tie = F.xxhash64("role", "text")  # the sampled range keys pass through the driver, so they are short
    order = [F.col("key"), F.col("turn").asc_nulls_first(), tie]
    ranged = named.repartitionByRange(*order).sortWithinPartitions(*order, "role", "text")
    return cut(ranged.withColumn("place", F.monotonically_increasing_id()), "repair-turns")


def conversation_key(id_col: str) -> Column:
    """A text for each id, one for null too."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{id_col}`").cast("string")), F.lit(""))


def faults(turns: DataFrame) -> DataFrame:
    """(key, place, initial, fault): the first fault of each row, '' if none; a narrow table."""
    text = F.btrim(F.col("text"), F.lit(STRIPPED))
    marked = turns.select(
        "key", "place", F.substring("role", 1, 1).alias("initial"),
        F.when(text == "", "blank").when(~F.substring(text, -1, 1).isin(".", "!", "?"), "truncated").otherwise("").alias("own"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(13), F.col("role"), F.col("text")).alias("h2"),
    )
    firsts = marked.groupBy("key", "h1", "h2").agg(F.min("place").alias("first")).select("first")
    fault = F.when((F.col("own") != "blank") & F.col("first").isNull(), "duplicate").otherwise(F.col("own"))
    return marked.join(firsts, F.col("place") == F.col("first"), "left").select("key", "place", "initial", fault.alias("fault"))


_CHOICE = "array<struct<entry: int, exit: int, cost: bigint, path: string>>"


def segments(marked: DataFrame) -> DataFrame:
    """One row per segment: places, symbols, initials at its ends, fault counts, illegal neighbours, choices."""
    grouped = marked.groupBy("key", F.expr(f"place div {SEGMENT}").alias("segment")).agg(F.sort_array(F.collect_list(F.struct("place", "initial", "fault"))).alias("rows"))
    rows = F.col("rows")
    kind = lambda r: F.when(r["initial"].isin("s", "u", "a"), r["initial"]).otherwise("o")
    symbol = lambda r: F.when(r["fault"].isin("blank", "duplicate"), "x").when(r["fault"] == "truncated", F.upper(kind(r))).otherwise(kind(r))
    illegal = F.size(F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i > 0) & ~legal(F.get(rows, i - 1)["initial"], F.get(rows, i)["initial"])))

    def counted(name: str) -> Column:
        return F.size(F.filter(rows, lambda r: r["fault"] == name)).cast("bigint").alias(name)

    @F.pandas_udf(_CHOICE)
    def choices(symbols: pd.Series) -> pd.Series:
        search = per_worker("segment_choices", lambda: lru_cache(REMEMBERED)(segment_choices))
        return symbols.map(search)

    flat = grouped.select(
        "key", "segment", F.transform(rows, lambda r: r["place"]).alias("places"), F.array_join(F.transform(rows, symbol), "").alias("symbols"),
        F.get(rows, F.lit(0))["initial"].alias("first"), F.get(rows, F.size(rows) - 1)["initial"].alias("last"),
        counted("blank"), counted("duplicate"), counted("truncated"), illegal.cast("bigint").alias("illegal"),
    )
    return cut(flat.withColumn("choices", choices("symbols")), "repair-segments")


def legal(a: Column, b: Column) -> Column:
    return F.concat(a, b).isin("su", "ua", "au")


_PICK_DDL = "key string, segment bigint, entry int, path string, cost bigint, illegal bigint"


def chosen_paths(found: DataFrame) -> DataFrame:
    """(key, segment, entry, path, cost, illegal): each segment's part of its conversation's cheapest edits.

    ``cost`` is the conversation's, given at its first segment (else 0); ``illegal`` counts the
    illegal pair that a segment makes with the one before it.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: str | None = None
        numbers: list[int] = []
        breaks: list[int] = []
        back: list[tuple] = []  # of each segment: for each exit the entry and path chosen
        sums: dict[int, tuple[int, int]] = {}  # state -> cost so far, place of its path in ASCII order
        last = ""
        ready: list[tuple] = []

        def close() -> None:
            if key is None:
                return
            state = min(sums, key=lambda s: (sums[s][0] + COST["I"] * len(TAIL[s]), sums[s][1]))
            cost, path_end = sums[state][0] + COST["I"] * len(TAIL[state]), TAIL[state]
            done = []
            for number, crossed, step in zip(reversed(numbers), reversed(breaks), reversed(back)):
                state, path = step[state]
                done.append((key, number, state, path + path_end, 0, crossed))
                path_end = ""
            done[-1] = (*done[-1][:4], cost, done[-1][5])
            ready.extend(done)

        def flush() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            made = [pa.array([r[k] for r in ready], kind) for k, kind in enumerate(kinds)]
            ready.clear()
            return pa.RecordBatch.from_arrays(made, names=["key", "segment", "entry", "path", "cost", "illegal"])

        for batch in batches:
            for now, number, first, end, options in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if now != key:
                    close()
                    key, numbers, breaks, back, sums, last = now, [], [], [], {START: (0, 0)}, None
                best: dict[int, tuple] = {}
                for o in options:
                    if o["entry"] in sums:
                        cost, place = sums[o["entry"]]
                        found = (cost + o["cost"], place, o["path"], o["entry"])
                        best[o["exit"]] = min(best.get(o["exit"], found), found)
                order = sorted(best, key=lambda t: best[t][1:3])
                sums = {t: (best[t][0], order.index(t)) for t in best}
                back.append({t: (best[t][3], best[t][2]) for t in best})
                numbers.append(number)
                breaks.append(int(last is not None and last + first not in ("su", "ua", "au")))
                last = end
            yield flush()
        close()
        yield flush()

    rows = found.select("key", "segment", "first", "last", "choices").repartition("key").sortWithinPartitions("key", "segment")
    return rows.mapInArrow(walk, _PICK_DDL)


class Repaired:
    """A repair: ``turns`` (key, place, step, role, text), the rows of every conversation in the order of (place, step), and ``report``, one row per key."""

    def __init__(self, turns: DataFrame, report: DataFrame) -> None:
        self.turns, self.report = turns, report


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repaired:
    """The repaired conversations, and per key: gaps, faults, illegal neighbours, cost and audit."""
    turns = ordered_turns(rows, id_col, turn_col, role_col, text_col)
    found = segments(faults(turns))
    paths = cut(chosen_paths(found), "repair-paths")

    @F.pandas_udf("array<struct<row: int, edit: string, role: string>>")
    def edited(symbols: pd.Series, entry: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([edited_rows(*args) for args in zip(symbols, entry, path)])

    steps = found.join(paths.select("key", "segment", "entry", "path"), ["key", "segment"]).select("key", "places", F.posexplode(edited("symbols", "entry", "path")).alias("step", "_e"))
    steps = steps.select("key", F.get("places", F.col("_e.row")).alias("place"), "step", F.col("_e.edit").alias("edit"), F.col("_e.role").alias("role"))
    new = steps.where("edit = 'I'").select("key", "place", "step", "role", F.lit("").alias("text"))
    old = turns.join(steps.where("edit in ('K', 'R')").withColumnRenamed("role", "new_role").drop("key"), "place").select("key", "place", "step", F.coalesce("new_role", "role").alias("role"), "text")

    spans = turns.groupBy("key", "turn").agg(F.lit(1).alias("one")).groupBy("key").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    counts = found.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    # One row holds a conversation's whole audit: that is the result.
    audits = paths.groupBy("key").agg(
        F.sum("cost").alias("cost"), F.sum("illegal").alias("crossed"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", "path"))), lambda p: p["path"]), "").alias("audit")
    )
    report = spans.join(counts, "key").join(audits, "key")
    return Repaired(new.unionByName(old), report.select("key", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("crossed")).alias("illegal"), "cost", "audit"))


def digests(turns: DataFrame) -> DataFrame:
    """(key, repaired_sha256): SHA-256 of each conversation's ``role:text`` lines, as a stream."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def flush() -> pa.RecordBatch:
            made = [pa.array([d[k] for d in done], pa.string()) for k in range(2)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=["key", "repaired_sha256"])

        for batch in batches:
            for key, role, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                key, line = key.as_py(), f"{role.as_py()}:{text.as_py()}"
                if state is None or key != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(line.encode())
                else:
                    state.update(f"\n{line}".encode())
            yield flush()
        if state is not None:
            done.append((now, state.hexdigest()))
        yield flush()

    return turns.repartition("key").sortWithinPartitions("key", "place", "step").select("key", "role", "text").mapInArrow(scan, "key string, repaired_sha256 string")


def audit_report(ids: DataFrame, repaired: Repaired, id_col: str = "conv_id") -> DataFrame:
    """One row per distinct id of ``ids``, with zeros for those without any row."""
    keys = ids.select(F.col(f"`{id_col}`")).distinct().withColumn("key", conversation_key(id_col))
    joined = keys.join(repaired.report, "key", "left").join(digests(repaired.turns), "key", "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(id_col, *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
