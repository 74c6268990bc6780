"""Secret scan: keyword automaton, anchored patterns at its hits, embedded checksums.

One pass over each whole text. An Aho-Corasick automaton finds every place where a keyword of a
pattern begins; only there is the pattern tried, anchored at that place. Kinds without any fixed
keyword (plain hexadecimal runs) have nothing to look for, so their pattern is searched for
directly. Tokens that embed a checksum are reported only if it fits.

Kinds, in the order in which spans at one place are listed:

``assign``  a password, secret, token or key that is assigned a value of 6 characters or more
``access``  an access key id, ``AKIA`` and 16 characters or more
``hex``     24 or more lower-case hexadecimal digits
``issued``  a prefixed token whose last 6 base-62 digits are the CRC-32 of the 30 before them
``signed``  a three-part web token whose header decodes to a JSON object that names its ``alg``
``private`` the first line of a private key block

Matches of one kind don't overlap and are found from left to right; a match that is too short is
dropped after it has been found, so what it covers is not searched again.

Results for odd input: a null or empty text has no spans; rows that repeat are scanned as often;
an empty table gives an empty result; input columns other than those named are ignored. Spans
count code points and end before ``end``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "issued", "signed", "private")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ISSUED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_SIGNED = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_TOKEN_RUN = re.compile(r"eyJ[A-Za-z0-9_-]+")
_PRIVATE = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----")

#: Keyword (lower case) -> kind. Every match of a kind begins with one of its keywords.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign",
    "akia": "access",
    "ghp_": "issued", "gho_": "issued", "ghu_": "issued", "ghs_": "issued", "ghr_": "issued", "npm_": "issued",
    "eyj": "signed",
    "-----begin ": "private",
}

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def checksum_fits(body: str, check: str) -> bool:
    """Whether ``check`` is the CRC-32 of ``body`` in six base-62 digits."""
    value = 0
    for c in check:
        value = value * 62 + _DIGITS.index(c)
    return value == zlib.crc32(body.encode())


def header_fits(part: str) -> bool:
    """Whether a web token's first part decodes to a JSON object with ``alg``."""
    try:
        header = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(header, dict) and "alg" in header


#: Kind -> (pattern, group whose text is the value, test of a match).
RULES = {
    "assign": (_ASSIGN, 2, lambda m: len(m[2]) >= 6),
    "access": (_ACCESS, 0, lambda m: len(m[0]) >= 20),
    "issued": (_ISSUED, 0, lambda m: checksum_fits(m[1], m[2])),
    "signed": (_SIGNED, 0, lambda m: header_fits(m[1])),
    "private": (_PRIVATE, 0, lambda m: True),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def text_spans(text: str, words: ahocorasick.Automaton) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of every secret in ``text``, by start, then kind."""
    spans = [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer
        low = text.translate(_LOWER)
    hits = sorted((end - length + 1, kind) for end, (length, kind) in words.iter(low))
    done = dict.fromkeys(RULES, 0)
    for start, kind in hits:
        pattern, group, fits = RULES[kind]
        if start < done[kind]:
            continue
        if not (m := pattern.match(text, start)):
            if kind == "signed" and (run := _TOKEN_RUN.match(text, start)):
                done[kind] = run.end()  # what follows the run doesn't fit, so no later start in it will
            continue
        done[kind] = m.end()
        if fits(m):
            spans.append((kind, start, m.end(), m[group]))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): every secret of every row of ``docs`` with its kind, place and value."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e, "value": v} for k, s, e, v in text_spans(text, words)] if (text := t.as_py()) else []
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], names=["id", "spans"])

    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = picked.mapInArrow(scan, f"id {picked.schema['id'].dataType.simpleString()}, spans {SPANS_DDL}")
    return out.withColumnRenamed("id", id_col)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
