"""Chat formatting by schema fingerprints.

A record is a JSON document. Its fingerprint is a hash of its nested field paths, list levels
marked; a fingerprint selects a declarative mapping to canonical turns (role, text), whatever
layout the record came in: a list of messages, a prompt and its response, an instruction with an
input and an output, or one turn per record. The turns of a conversation, in order, are written in
one template:

    <|im_start|>role\\ntext<|im_end|>\\n

Control strings inside texts and roles are escaped by one more backslash between ``<`` and ``|``,
which reading back removes. A loss mask marks where the assistant's texts stand.

Conversations are formatted and read back as streams within a task: a conversation becomes chunks
of about ``CHUNK_CHARS`` characters, each with whole turns, so memory is bounded by a chunk and the
longest turn, however many turns a conversation has.

Paths that a mapping declares ignorable (ids, sources and the like, with all below them) don't count
for its fingerprint. A message's ``weight`` is not among them, as it may keep a text out of the loss.

Results for odd input: a missing or null text of a message is empty, a missing or null role is the
empty role; a message that is no object is a turn of role ``unmapped`` with its JSON (a string as it
is) as text; half a surrogate pair becomes U+FFFD; records of one place
are ordered by role and text, so reruns agree; rows that repeat are turns of their own; a null
conversation id is a conversation; a record that is no JSON object, is nested beyond Python's stack, or whose fingerprint no
mapping has, is one turn of role ``unmapped`` with the record as its text, outside the loss mask.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
UNMAPPED = "unmapped"
CHUNK_CHARS = 1 << 20

#: Other names of the canonical roles, in layouts that use them.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: Fields of a record, and of a message, that say nothing of its turns.
RECORD_NOTES = ("created", "id", "lang", "meta", "metadata", "name", "source", "timestamp", "weight")
MESSAGE_NOTES = ("id", "metadata", "name", "source", "timestamp")

#: Declarative mappings. ``list``: where the messages are and which of their fields is what;
#: ``fields``: for each turn its role and the fields whose texts, joined by an empty line, it says.
#: Paths in ``optional`` may be absent: each choice of them has a fingerprint of its own; ``ignored``
#: ones are removed before the hash. Of a message's paths any may be absent.
LAYOUTS = (
    {"name": "turn", "fields": [(("role",), ("text",))], "paths": ("role", "text"), "optional": (), "ignored": RECORD_NOTES},
    *(
        {
            "name": where,
            "list": where,
            "role": role,
            "text": text,
            "paths": (),
            "optional": (f"{where}[]", f"{where}[].{role}", f"{where}[].{text}"),
            "ignored": (*RECORD_NOTES, *(f"{where}[].{n}" for n in MESSAGE_NOTES)),
        }
        for where, role, text in (("messages", "role", "content"), ("conversations", "from", "value"))
    ),
    {
        "name": "prompt",
        "fields": [("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))],
        "paths": ("prompt", "response"),
        "optional": ("system",),
        "ignored": RECORD_NOTES,
    },
    {
        "name": "instruction",
        "fields": [("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))],
        "paths": ("instruction", "output"),
        "optional": ("input", "system"),
        "ignored": RECORD_NOTES,
    },
)
#: Fingerprints that an index holds at most; others are looked up anew.
KNOWN = 10_000

_PLAIN = re.compile(r"""[^.\[\]"\n]+""")
_SURROGATE = re.compile("[\ud800-\udfff]")


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of the fields that hold values; ``[]`` marks a list, names that could be taken for a path are quoted."""
    if isinstance(value, dict):
        named = ((k if _PLAIN.fullmatch(k) else json.dumps(k), v) for k, v in value.items())
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in named)) if value else {at}
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def layout_index(layouts: tuple[dict, ...] = LAYOUTS) -> dict[str, dict | None]:
    """Fingerprint -> mapping, for every choice of a mapping's optional paths."""
    found: dict[str, dict | None] = {}
    for layout in layouts:
        for n in range(len(layout["optional"]) + 1):
            for extra in combinations(layout["optional"], n):
                if layout["paths"] or extra:
                    found[fingerprint({*layout["paths"], *extra})] = layout
    return found


def _without(paths: set[str], ignored: tuple[str, ...]) -> set[str]:
    below = tuple(f"{i}{mark}" for i in ignored for mark in (".", "[]"))
    return {p for p in paths if p not in ignored and not p.startswith(below)}


def layout_of(paths: set[str], index: dict[str, dict | None]) -> dict | None:
    """The mapping of a record with these paths; the index remembers what it was asked."""
    key = fingerprint(paths)
    if key in index:
        return index[key]
    layouts = {id(layout): layout for layout in index.values() if layout}.values()
    found = next((layout for layout in layouts if index.get(fingerprint(_without(paths, layout.get("ignored", ())))) is layout), None)
    if len(index) < KNOWN:
        index[key] = found
    return found


def _text(value: object) -> str:
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text if text.isascii() else _SURROGATE.sub("\ufffd", text)


def record_turns(record: str | None, index: dict[str, dict | None]) -> list[tuple[str, str, str]]:
    """(layout, role, text) of each turn of a record."""
    try:
        value = json.loads(record or "")
        layout = layout_of(field_paths(value), index) if isinstance(value, dict) else None
    except (ValueError, RecursionError):
        layout = None
    if layout is None:
        return [(UNMAPPED, UNMAPPED, record or "")]
    name = layout["name"]
    if "list" in layout:
        turns = [(_text(m.get(layout["role"])), _text(m.get(layout["text"]))) if isinstance(m, dict) else (UNMAPPED, m if isinstance(m, str) else json.dumps(m)) for m in value[layout["list"]]]
        return [(name, ROLE_NAMES.get(role, role), _text(text)) for role, text in turns]
    found = []
    for role, fields in layout["fields"]:
        present = [_text(value[f]) for f in fields if f in value]
        if present:
            # A role that is itself a path is read from the record.
            found.append((name, _text(value[role[0]]) if isinstance(role, tuple) else role, "\n\n".join(t for t in present if t)))
    return found


def canonical_turns(records: DataFrame, id_col: str, order_col: str, record_col: str, layouts: tuple[dict, ...] = LAYOUTS) -> DataFrame:
    """(id, place, part, layout, role, text): the turns of every record, ``part`` counting within it."""
    index = layout_index(layouts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                found = [(row, part, *turn) for row, record in enumerate(piece.column(2).to_pylist()) for part, turn in enumerate(record_turns(record, index))]
                rows = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(rows), piece.column(1).take(rows), pa.array([f[1] for f in found], pa.int32())]
                    + [pa.array([f[k] for f in found], pa.string()) for k in (2, 3, 4)],
                    names=["id", "place", "part", "layout", "role", "text"],
                )

    picked = records.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{order_col}`").cast("long").alias("place"), F.col(f"`{record_col}`").cast("string").alias("record"))
    return picked.mapInArrow(scan, "id bigint, place bigint, part int, layout string, role string, text string")


_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\+)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escaped(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: "<" + m[1][1:] + "|", text)


def escaped_role(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role), flags=re.S)


_CHUNK_DDL = "id bigint, chunk bigint, formatted string, loss array<struct<start:bigint,end:bigint>>"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_turns(turns: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(id, chunk, formatted, loss): each conversation in the template; ``loss`` places are within a chunk."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        now: int | None = None
        chunk, begun, size = 0, False, 0
        parts: list[str] = []
        loss: list[dict] = []

        def close() -> None:
            nonlocal parts, loss, size, chunk
            if parts:
                ready.append((now, chunk, "".join(parts), loss))
            parts, loss, size, chunk = [], [], 0, chunk + 1

        def flush() -> pa.RecordBatch:
            made = [pa.array([r[0] for r in ready], pa.int64()), pa.array([r[1] for r in ready], pa.int64()), pa.array([r[2] for r in ready], pa.string()), pa.array([r[3] for r in ready], _LOSS)]
            ready.clear()
            return pa.RecordBatch.from_arrays(made, names=["id", "chunk", "formatted", "loss"])

        held = 0
        for batch in batches:
            for key, role, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                key, role, text = key.as_py(), role.as_py() or "", text.as_py() or ""
                if not begun or key != now:
                    if begun:
                        close()
                    now, begun, chunk = key, True, 0
                head, body = f"{START}{escaped_role(role)}\n", escaped(text)
                if role == LOSS_ROLE:
                    loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
                parts += [head, body, f"{END}\n"]
                size += len(head) + len(body) + len(END) + 1
                held += len(body)
                if size >= chunk_chars:
                    close()
                if held >= chunk_chars:
                    yield flush()
                    held = 0
        if begun:
            close()
        yield flush()

    order = ["id", "place", "part", "role", "text"]
    rows = turns.select("id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "place", "part")
    return rows.repartition("id").sortWithinPartitions(*order).select("id", "role", "text").mapInArrow(scan, _CHUNK_DDL)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of formatted text."""
    for m in _TURN.finditer(formatted):
        yield unescaped_role(m[1]), unescaped(m[2])


def read_loss(formatted: str, loss: list[dict]) -> Iterator[str]:
    """The texts under the loss mask."""
    for span in loss:
        yield unescaped(formatted[span["start"] : span["end"]])


def digests(chunks: DataFrame) -> DataFrame:
    """One row per conversation, read back from its chunks as a stream: counts and hashes of turns and loss texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: int | None = None
        begun = False
        turns = loss = n_turns = loss_chars = chars = None

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            made = [pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for key, text, spans in zip(batch.column(0), batch.column(1), batch.column(2)):
                key, text, spans = key.as_py(), text.as_py(), spans.as_py()
                if not begun or key != now:
                    if begun:
                        done.append((now, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    now, begun = key, True
                    turns, loss, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for role, said in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                for said in read_loss(text, spans):
                    loss.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
            yield flush()
        if begun:
            done.append((now, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        yield flush()

    rows = chunks.repartition("id").sortWithinPartitions("id", "chunk").select("id", "formatted", "loss")
    return rows.mapInArrow(scan, "id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def turn_record(role: str = "role", text: str = "text") -> Column:
    """A table row of one turn as a record of layout ``turn``."""
    return F.to_json(F.struct(F.col(role).cast("string").alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), {"ignoreNullFields": "false"})
