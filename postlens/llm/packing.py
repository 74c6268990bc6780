"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

A document is its token ids and an end id. It is cut into full windows, which need no packing, and
a rest of less than one window, cut into pieces of at most ``max_piece`` ids. Rests are dealt by
hash into groups of about ``GROUP_PIECES`` pieces; each group is partitioned into
``ceil(ids / window)`` windows by multiway differencing: every piece starts as a partition of its
own, and the two partitions with the widest spread are merged again and again, the fullest window
of one with the emptiest of the other, until one is left whose windows are nearly equal. If a
window then exceeds the capacity, the group is partitioned anew into one window more.

A full window gets a number of its own where it stands: it is not shuffled and joins no group. The
number of groups follows the number of rests, so a group has about ``GROUP_PIECES`` pieces however
long the documents are; only copies of a row, with the same id and place, always share a group.

Results for odd input: a null or empty text is the end id alone, one piece; a text of any length is
tokenized in blocks and cut; rows that repeat, also with the same id, are packed as rows of their
own; an empty table gives an empty result; a null id stays null. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import cut, per_worker

WINDOW = 1024
MAX_PIECE = 256
GROUP_PIECES = 512
#: Least sequence id of a full window.
FULL = 1 << 62
#: Distinct words of a generation whose ids a worker remembers.
MEMORY_WORDS = 400_000
#: Bytes of text that are encoded together.
BATCH_BYTES = 1 << 22

#: White space as the pre-tokenizer sees it (Unicode's White_Space).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNKS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_RUN = re.compile(f"[{_SPACE}][{_SPACE}]")


def default_tokenizer() -> str:
    """Path of the byte-level vocabulary that the registered query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Memo(dict):
    """Word -> its ids as bytes, made on first use.

    Two generations bound the memory: what was not used since the last turn is forgotten.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int = MEMORY_WORDS):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        self[word] = found
        return found

    def turn(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


def byte_letters() -> dict[int, str]:
    """Byte -> the printable character that byte-level vocabularies write for it (a fixed rule)."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


class WordEncoder:
    """Ids of whole texts from the ids of their words, each distinct word encoded once.

    For byte-level vocabularies whose pre-tokenizer never joins a character to a space after it,
    and takes a single line end between words as a token of its own: a text may then be split at
    every single line end and before every single space without changing its ids. Other texts
    (runs of white space) are split by the pre-tokenizer's own rule for white space. Special
    tokens spelled out in a text keep their ids, so texts that hold one are encoded whole.
    """

    def __init__(self, path: str, end_id: int = 0):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.tokens = Memo(self._token)  # by pre-token, written in byte letters
        self.spaced = Memo(self._spaced_word)  # by word after a space
        self.bare = Memo(self._chunk)
        self.marks = {m: self._chunk(m) for m in ".,"}
        self.line_end = self._chunk("\n")
        self.end = np.array([end_id], dtype="<u4").tobytes()
        # Texts that go the slower way: with special tokens, or characters that libraries may class differently.
        self.merges = merge_encoder(path)
        self.odd = "|".join([f"[^{_SETTLED}]", *map(re.escape, self.special)]) if self.merges else ""

    def _token(self, token: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(token)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without special tokens, pre-token by pre-token."""
        return b"".join([self.tokens[token] for token, _ in self.split(chunk)])

    def _spaced_word(self, word: str) -> bytes:
        """Ids of a space and ``word``."""
        if word.isalpha():  # letters only: one pre-token
            return self._token("Ġ" + (word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)))
        if word[-1:] in self.marks and word[:-1].isalpha():
            return self.spaced[word[:-1]] + self.marks[word[-1]]
        return self._chunk(" " + word)

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        for memo in (self.tokens, self.spaced, self.bare):
            memo.turn()
        if _RUN.search(text):
            return b"".join(map(self.bare.__getitem__, _CHUNKS.findall(text)))
        spaced, found = self.spaced.__getitem__, []
        for line in text.split("\n"):
            first, *words = line.split(" ")
            found += (self.line_end, self.bare[first], *map(spaced, words))
        return b"".join(found[1:])

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each followed by ``end_id``; how many each has)."""
        odd = pc.match_substring_regex(texts, self.odd).to_pylist()
        merged = self.merges
        parts: list = []
        for text, apart in zip(texts.to_pylist(), odd):
            parts += (self.encode(text) if apart else merged.encode_to_tiktoken_buffer(text, _NONE), self.end)
        sizes = np.fromiter((memoryview(p).nbytes for p in parts), dtype=np.int64, count=len(parts)) // 4
        return np.frombuffer(b"".join(parts), dtype="<u4"), sizes[0::2] + 1


#: How plain byte-level vocabularies cut texts into pre-tokens (a fixed rule).
_PRE_TOKENS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose class is the same in every version of Unicode, as far as the vocabularies' texts go.
_SETTLED = r"\x00-\x{24F}\x{4E00}-\x{9FA5}"
_NONE: set[str] = set()


def merge_encoder(path: str):
    """A byte-pair encoder that merges by token id and writes ids into one buffer, for plain byte-level
    vocabularies whose merges stand in the order of their ids; None for others."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model, cut_rule = made["model"], made.get("pre_tokenizer") or {}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    merged = [model["vocab"][a + b] for a, b in pairs]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    unused = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if (
        model["type"] != "BPE" or made.get("normalizer") or {k: cut_rule.get(k, True) for k in plain} != plain
        or any(model.get(k) for k in unused) or any(x >= y for x, y in zip(merged, merged[1:]))
    ):
        return None
    byte = {letter: b for b, letter in byte_letters().items()}
    added = {t["content"] for t in made["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): number for token, number in model["vocab"].items() if token not in added}
    return tiktoken.Encoding("vocabulary", pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})._core_bpe


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, window: int = WINDOW, max_piece: int = MAX_PIECE
) -> DataFrame:
    """(id, start, length, ids, doc_tokens): the pieces of every row; ``ids`` as little-endian 32-bit numbers."""

    def cut_up(rows: pa.RecordBatch, encoder: WordEncoder) -> pa.RecordBatch:
        ids, totals = encoder.encode_all(pc.fill_null(rows.column(1), ""))
        full = totals // window
        number = full + -(-(totals - full * window) // max_piece)
        owner = np.repeat(np.arange(len(totals)), number)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        whole = place < full[owner]
        start = np.where(whole, place * window, full[owner] * window + (place - full[owner]) * max_piece)
        length = np.where(whole, window, np.minimum(max_piece, totals[owner] - start))
        # The pieces lie one after the other in the ids, so they are cut by their offsets alone.
        offsets = np.concatenate(([0], np.cumsum(4 * length))).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids, dtype="<u4"))])
        made = [rows.column(0).take(pa.array(owner)), pa.array(start), pa.array(length), pieces, pa.array(totals[owner])]
        return pa.RecordBatch.from_arrays(made, names=["id", "start", "length", "ids", "doc_tokens"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"{tokenizer} {end_id}", lambda: WordEncoder(tokenizer, end_id))  # words are remembered across tasks
        for batch in batches:
            # Some megabytes of text at once; a longer text goes alone.
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, side="right"))
                upto = max(upto, at + 1)
                yield cut_up(batch.slice(at, upto - at), encoder)
                at = upto

    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(scan, f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint").withColumnRenamed("id", id_col)


def difference(sizes: Sequence[int], windows: int) -> list[list[int]]:
    """``windows`` lists of places in ``sizes`` with nearly equal sums, by multiway differencing.

    A partition keeps its used windows only, fullest first, as (sum, pieces); the pieces are
    nested pairs, flattened at the end. Equal spreads are taken in the order in which they arose,
    so a rerun gives the same windows.
    """
    order = count()
    heap = [(-size, next(order), [(size, place)]) for place, size in sorted(enumerate(sizes), key=lambda x: (-x[1], x[0]))]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        free = windows - len(a)
        # The fullest windows of b go to the unused, then to the emptiest windows of a.
        merged = a[: len(a) - max(0, len(b) - free)] + b[:free]
        if len(b) > free:
            merged += [(x[0] + y[0], (x[1], y[1])) for x, y in zip(reversed(a), b[free:])]
        merged.sort(key=lambda x: -x[0])
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (least - merged[0][0], next(order), merged))
    found: list[list[int]] = []
    for _, nested in heap[0][2] if heap else []:
        flat, stack = [], [nested]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                flat.append(x)
        found.append(sorted(flat))
    return found


def fitted(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """The fewest windows, from ``ceil(sum / capacity)`` on, whose differencing exceeds no capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, windows)
        if all(sum(sizes[p] for p in w) <= capacity for w in found):
            return found
        windows += 1


def pack(pieces: DataFrame, length_col: str = "length", window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: the window of each piece and its place there.

    Every column of ``pieces`` goes along; drop what is not needed beforehand.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    keys = [F.col(f"`{c}`") for c, kind in pieces.select(*[F.col(f"`{c}`") for c in names]).dtypes if kind != "binary"]
    rows = cut(pieces.select(*[F.col(f"`{c}`") for c in names]), "pieces")
    fills = F.col(f"`{length_col}`") >= window
    # Numbers from FULL on don't meet those of the groups; the rows are read from files, so a retry numbers alike.
    full = rows.where(fills).withColumns({"sequence_id": F.lit(FULL) + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    rests = rows.where(~fills)
    groups = max(1, -(-rests.count() // group_pieces))
    # Rows that repeat are dealt out like all others: by their place in the files, which a retry finds alike.
    dealt = rests.withColumn("_tie", F.xxhash64(*keys)).withColumn("_bucket", F.pmod(F.xxhash64("_tie", F.monotonically_increasing_id()), F.lit(groups)))

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        # An order that does not depend on how the rows arrived.
        group = group.sort_values([length_col, "_tie"], ascending=[False, True], kind="stable").reset_index(drop=True)
        sizes = group[length_col].to_numpy()
        windows = fitted(sizes.tolist(), window)
        number = np.zeros(len(sizes), dtype=np.int64)
        offset = np.zeros(len(sizes), dtype=np.int64)
        for w, members in enumerate(windows):
            at = 0
            for i in members:
                number[i], offset[i] = (key[0] << 32) + w, at
                at += sizes[i]
        return group[names].assign(sequence_id=number, offset=offset)

    return dealt.groupBy("_bucket").applyInPandas(place, full.schema).unionByName(full)
