"""Segmentation of Han text: words learned from the text itself, best path through the lattice.

Text without spaces is counted as whole runs of Han characters by ``functions/text.py``; here such runs
are cut into words. Everything starts from *counted* runs, one row per distinct run, so a phrase that
repeats in a third of all texts is looked at once.

Words are learned from n-gram counts (all distributed aggregates, no text is gathered):

* ``n``: occurrences of the n-gram, in at least ``min_count`` places;
* ``cohesion``: the least, over all ways to cut it in two, of ``ln(n T / (n1 n2))``, with ``T`` the
  number of all characters: how much more often its parts stand together than by chance;
* ``left`` and ``right``: the entropy of the characters before and after it; each run edge counts as
  a character of its own. A part of a word has few neighbours on its open side.

All three are whole numbers of thousandths. N-grams that occur once are dropped after the count:
``n ln n`` is 0 for them, so no entropy changes, and none of them can be a word or a part of one.

A run is then cut into the words whose costs ``1000 (ln T - ln n)`` add up to the least (dynamic programming
over the lattice of all words in it; of equal sums the one with the longest first word, then the
longest second word, and so on). Every single character is a word too. Users add words of their own.

The lexicon is measured: up to ``MAX_WORDS`` words and ``MAX_BYTES`` bytes it is sent to the tasks;
beyond that the substrings of the runs are joined with it and each run is cut with the words
found in it, with the same result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import HAN_RUN
from postlens.operators import skills
from postlens.session import shared_dir

# Tasks get these functions with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 4
MIN_COUNT = 5
#: Least cohesion and entropy of a learned word, in thousandths.
MIN_COHESION = 1000
MIN_FREEDOM = 500
#: What a lexicon may hold to be sent to the tasks.
MAX_WORDS = 1_000_000
MAX_BYTES = 32 << 20
#: Characters whose windows a task counts at once (some 150 MB).
CHUNK = 1 << 21


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder."""
    shared_dir(df.sparkSession)  # makes sure the context has its checkpoint folder
    return df.checkpoint(eager=True)


def is_run(token: Column) -> Column:
    return token.rlike(f"^{HAN_RUN}\\z")


def _thousandths(x: Column) -> Column:
    return F.round(x * 1000).cast("bigint")


def _characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The strings of a column one after another: their bytes, the byte that each character begins at (and the end),
    the characters, and the character that each string begins at (and the end)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    heads = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    return raw, heads, points, np.searchsorted(heads, offsets - offsets[0])


def _groups(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` characters, of one row at least; ``bounds`` as in :func:`_characters`."""
    row = 0
    while row < len(bounds) - 1:
        upto = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1)
        yield row, upto
        row = upto


def _window_counts(points: np.ndarray, sizes: np.ndarray, owned: np.ndarray, weights: np.ndarray, longest: int) -> tuple[list[str], np.ndarray]:
    """The distinct windows of the runs (their characters, and the number of them) with their sums of weights: one window of
    ``longest`` characters (or up to the run's end) from each of the first ``owned`` places of a run."""
    present = np.zeros(0x110000, np.bool_)
    present[points] = True
    dense = np.cumsum(present)[points]  # from 1; 0 stands for the place after a run
    base = int(present.sum()) + 1
    weight = np.repeat(weights, sizes)
    if owned.sum() < len(points):  # the rest of a cut run's part begins no window
        place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        begin = np.flatnonzero(place < np.repeat(owned, sizes))
    else:
        begin = np.arange(len(points))
    if base**longest < 1 << 63:  # a window is a number of ``longest`` digits
        ends = np.cumsum(sizes + 1) - 1
        inside = np.ones(len(points) + len(sizes), np.bool_)
        inside[ends] = False
        digit = np.zeros(len(inside), np.int64)
        digit[inside] = dense
        code = digit
        for k in range(1, longest):
            code = digit * base**k + np.append(code[1:], 0)
            code[ends] = 0
        code, weight = code[inside][begin], weight[begin]
        once = weight == 1  # most: these are only sorted
        alone = np.sort(code[once])
        begins = np.flatnonzero(np.diff(alone, prepend=-1))
        code, weight = code[~once], weight[~once]
        codes, found = np.unique(np.concatenate([alone[begins], code]), return_inverse=True)
        sums = np.zeros(len(codes), np.int64)
        np.add.at(sums, found.reshape(-1), np.concatenate([np.diff(begins, append=len(alone)), weight]))
        digits = np.stack([codes // base**k % base for k in range(longest - 1, -1, -1)], axis=1)
        letters = np.flatnonzero(present).astype(np.uint32)
        text = letters[digits[digits > 0] - 1].tobytes().decode("utf-32-le", "surrogatepass")
        upto = np.cumsum((digits > 0).sum(axis=1)).tolist()
        return [text[a:b] for a, b in zip([0, *upto], upto)], sums
    text = points.tobytes().decode("utf-32-le", "surrogatepass")
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # characters up to the run's end
    code, top = dense.copy(), base
    for k in range(1, min(longest, len(points))):
        if top * base >= 1 << 63:
            code = np.unique(code, return_inverse=True)[1].reshape(-1).astype(np.int64)
            top = int(code.max()) + 1
        code *= base
        code[: len(points) - k] += np.where(room[: len(points) - k] > k, dense[k:], 0)
        top *= base
    code, weight = code[begin], weight[begin]
    order = np.argsort(code)
    code = code[order]
    begins = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    sums = np.add.reduceat(weight[order], begins)
    first = begin[order[begins]]
    return [text[a:b] for a, b in zip(first.tolist(), (first + np.minimum(room[first], longest)).tolist())], sums


def _windows(runs: DataFrame, longest: int) -> DataFrame:
    """``gram, n`` — :func:`_window_counts` of every ``CHUNK`` characters of ``run, n`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[pa.RecordBatch]:
            grams, sums = _window_counts(*(np.concatenate(parts) for parts in zip(*held)), longest)
            for at in range(0, len(grams), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(grams[at : at + (1 << 16)], pa.string()), pa.array(sums[at : at + (1 << 16)])], names=["gram", "n"])

        held, size = [], 0  # characters, sizes, owned places and weights of runs
        for batch in batches:
            _, _, points, bounds = _characters(batch.column(0))
            n = batch.column(1).to_numpy(zero_copy_only=False)
            for row, upto in _groups(bounds, CHUNK):
                # A run beyond a chunk is cut into parts that begin with windows of their own and overlap by the rest of the last.
                low, high = int(bounds[row]), int(bounds[upto])
                for at in range(low, high, CHUNK):
                    part = points[at : min(at + CHUNK + longest - 1, high)]
                    if high - low <= CHUNK:
                        sizes = np.diff(bounds[row : upto + 1])
                        held.append((part, sizes, sizes, n[row:upto]))
                    else:
                        held.append((part, np.array([len(part)]), np.array([min(CHUNK, high - at)]), n[row:upto]))
                    size += len(part)
                    if size >= CHUNK:
                        yield from found()
                        held, size = [], 0
        if size:
            yield from found()

    return runs.select("run", "n").mapInArrow(count, "gram string, n bigint")


def ngram_counts(runs: DataFrame, longest: int) -> DataFrame:
    """``gram, n`` — the n-grams of 1 to ``longest`` characters that occur at least twice in ``run, n`` rows.

    Every place of a run has one window of ``longest`` characters (fewer at its end). Windows are counted first,
    by numpy within the tasks, then over all tasks; an n-gram occurs as often as the windows that begin with it.
    """
    places = _windows(runs.where((F.char_length("run") > 0) & F.col("n").isNotNull()), longest).groupBy("gram").agg(F.sum("n").alias("n"))
    grams = places.select("n", F.explode(F.sequence(F.lit(1), F.char_length("gram"))).alias("size"), F.col("gram").alias("window"))
    counted = grams.groupBy(F.substr("window", F.lit(1), F.col("size")).alias("gram")).agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") > 1)


def characters(runs: DataFrame) -> DataFrame:
    """One row: ``total``, the number of characters in ``run, n`` rows."""
    return runs.agg(F.coalesce(F.sum(F.col("n") * F.char_length("run")), F.lit(0)).alias("total"))


def word_statistics(grams: DataFrame, total: int, longest: int = LONGEST, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n, cohesion, left, right`` of every n-gram of 2 to ``longest`` characters with at least
    ``min_count`` occurrences; ``grams`` (see :func:`ngram_counts`) must hold those of one character more."""
    size, n = F.char_length("gram"), F.col("n")
    found = grams.where((size >= 2) & (size <= longest) & (n >= max(2, min_count))).withColumnRenamed("gram", "word")
    weight = F.sum(n * F.ln(n))
    wider = grams.where(size >= 2)
    left = wider.groupBy(F.substr("gram", F.lit(2)).alias("word")).agg(weight.alias("_left"))
    right = wider.groupBy(F.substr(F.col("gram"), F.lit(1), size - 1).alias("word")).agg(weight.alias("_right"))

    # Both parts of every cut of a word: one join finds their counts.
    cuts = found.select("word", F.explode(F.sequence(F.lit(1), F.char_length("word") - 1)).alias("cut"))
    head, tail = F.substr(F.col("word"), F.lit(1), F.col("cut")), F.substr("word", F.col("cut") + 1)
    parts = cuts.select("word", "cut", F.explode(F.array(head, tail)).alias("gram")).join(grams, "gram")
    apart = parts.groupBy("word", "cut").agg(F.sum(F.ln("n")).alias("_apart")).groupBy("word").agg(F.max("_apart").alias("_apart"))

    def freedom(weighted: str) -> Column:
        return _thousandths(F.ln("n") - F.coalesce(F.col(weighted), F.lit(0.0)) / n)

    joined = found.join(left, "word", "left").join(right, "word", "left").join(apart, "word")
    cohesion = F.ln("n") + F.ln(F.lit(float(max(total, 1)))) - F.col("_apart")
    return joined.select("word", "n", _thousandths(cohesion).alias("cohesion"), freedom("_left").alias("left"), freedom("_right").alias("right"))


class Lexicon:
    """Words with their costs (``word, cost``), the cost of any other character, and the longest word."""

    def __init__(self, words: DataFrame, other: int, longest: int) -> None:
        self.words, self.other, self.longest = words, other, longest


def learn(
    runs: DataFrame,
    user_words: DataFrame | None = None,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    min_cohesion: int = MIN_COHESION,
    min_freedom: int = MIN_FREEDOM,
) -> Lexicon:
    """The lexicon of ``run, n`` rows: their words by the statistics, the Han words of ``user_words``
    (``word``; of any length, also such as never occur), and single characters."""
    total = characters(runs).first()["total"]
    grams = _kept(ngram_counts(runs, longest + 1))
    statistics = word_statistics(grams, total, longest, min_count)
    good = (F.col("cohesion") >= min_cohesion) & (F.col("left") >= min_freedom) & (F.col("right") >= min_freedom)
    words = statistics.where(good).select("word", "n")
    words = words.unionByName(grams.where(F.char_length("gram") == 1).select(F.col("gram").alias("word"), "n"))
    if user_words is not None:
        own = user_words.select("word").where(is_run(F.col("word")) & (F.char_length("word") > 1)).distinct()
        beyond = own.agg(F.max(F.char_length("word"))).first()[0] or 0
        if beyond > longest + 1:  # their counts aren't among the n-grams
            longer = own.where(F.char_length("word") > longest + 1)
            counted = longer.join(ngram_counts(runs, beyond).withColumnRenamed("gram", "word"), "word").select("word", "n")
            grams = grams.unionByName(counted.withColumnRenamed("word", "gram"))
        longest = max(longest, beyond)
        own = own.join(grams.withColumnRenamed("gram", "word"), "word", "left").select("word", F.coalesce("n", F.lit(1)).alias("n"))
        words = words.join(own.select("word"), "word", "left_anti").unionByName(own)
    ln_total = F.ln(F.lit(float(max(total, 1))))
    costs = words.select("word", _thousandths(ln_total - F.ln("n")).alias("cost"))
    other = runs.sparkSession.range(1).select(_thousandths(ln_total).alias("c")).first()["c"]
    return Lexicon(_kept(costs), other, longest)


def best_words(run: str, costs: Mapping[str, int], other: int, longest: int) -> list[str]:
    """The words of a run whose costs add up to the least; of equal sums the longest first word, and so on."""
    size = len(run)
    least, step = [0] * (size + 1), [1] * (size + 1)
    for at in range(size - 1, -1, -1):
        best, length = least[at + 1] + costs.get(run[at], other), 1
        for k in range(2, min(longest, size - at) + 1):
            cost = costs.get(run[at : at + k])
            if cost is not None and cost + least[at + k] <= best:
                best, length = cost + least[at + k], k
        least[at], step[at] = best, length
    out, at = [], 0
    while at < size:
        out.append(run[at : at + step[at]])
        at += step[at]
    return out


class Lattice:
    """The words of a lexicon as a trie in arrays, to cut many runs at once as :func:`best_words` cuts one.

    A state is a prefix of words; level ``k`` has the keys ``state of k - 1 characters * base + next character``
    of its states in order, and their words' costs (``NONE``: a prefix only). State 0 is none.
    """

    NONE = 1 << 60
    #: Keys up to which a level is looked up in a table of all keys.
    TABLE = 1 << 20
    #: Long pieces that are cut one by one.
    FEW = 16

    def __init__(self, costs: Mapping[str, int], other: int, longest: int) -> None:
        letters = np.array(sorted({ord(c) for word in costs for c in word}), np.int64)
        self.letters, self.base = letters, len(letters) + 1
        dense = self._dense()
        self.single = np.full(self.base, other, np.int64)
        words = [w for w in costs if 1 < len(w) <= longest]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        text = dense[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        for w, cost in costs.items():
            if len(w) == 1:
                self.single[dense[ord(w)]] = cost
        cost = np.array([costs[w] for w in words], np.int64)
        state = text[ends - sizes].astype(np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray, dict[int, str]]] = []
        for k in range(2, int(sizes.max(initial=1)) + 1):
            long = np.flatnonzero(sizes >= k)
            keys, found = np.unique(state[long] * self.base + text[(ends - sizes)[long] + k - 1], return_inverse=True)
            state[long] = found.reshape(-1) + 1
            own = np.full(len(keys) + 1, self.NONE, np.int64)
            whole = np.flatnonzero(sizes == k)
            own[state[whole]] = cost[whole]
            self.levels.append((keys, own, dict(zip(state[whole].tolist(), [words[i] for i in whole]))))

    def _dense(self) -> np.ndarray:
        dense = np.zeros(0x110000, np.int32)
        dense[self.letters] = np.arange(1, self.base)
        return dense

    @classmethod
    def of(cls, parts: Mapping[str, object]) -> Lattice:
        """The lattice of those attributes with its tables, made in the task."""
        self = cls.__new__(cls)
        vars(self).update(parts)
        self.dense, self.tables, states = self._dense(), [], self.base
        for keys, own, _ in self.levels:
            table = None
            if states * self.base <= self.TABLE:
                table = np.zeros(states * self.base, np.int32)
                table[keys] = np.arange(1, len(keys) + 1)
            self.tables.append(table)
            states = len(own)
        return self

    def _next(self, k: int, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states of ``k`` characters that ``letter`` leads to."""
        keys, table = self.levels[k - 2][0], self.tables[k - 2]
        if table is not None:
            return table[state * self.base + letter]
        key = state.astype(np.int64) * self.base + letter
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, at + 1, 0).astype(np.int32)

    def steps(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The characters that words begin at, in order, and the words' sizes; ``bounds`` are the runs' beginnings and the end."""
        letter, size = self.dense[points], len(points)
        fits, sizes = np.ones(size, np.bool_), np.diff(bounds)
        single, longer = self.single[letter], []
        begins = np.ones(size + 1, np.bool_)  # no word holds the character and the one before: a cut in any case
        place, state = np.arange(size, dtype=np.int32), letter
        for k in range(2, len(self.levels) + 2):
            fits[(bounds[1:] - k + 1)[sizes >= k - 1]] = False  # fewer than k characters up to the run's end
            alive = (state > 0) & fits[place]
            place = place[alive]
            state = self._next(k, state[alive], letter[place + k - 1])
            cost = self.levels[k - 2][1][state]
            whole = cost < self.NONE
            if whole.any():
                costs, at = np.full(size, self.NONE, np.int64), place[whole]
                costs[at] = cost[whole]
                longer.append((k, costs))
                for j in range(1, k):
                    begins[at + j] = False
        step = np.ones(size, np.int64)
        first = np.flatnonzero(begins)
        pieces = np.diff(first)
        first, pieces = first[:-1][pieces > 1], pieces[pieces > 1]
        order = np.argsort(-pieces, kind="stable")
        first, pieces = first[order], pieces[order]
        if len(first):
            few = int((pieces > pieces[min(self.FEW, len(pieces)) - 1]).sum())
            for a, n in zip(first[:few].tolist(), pieces[:few].tolist()):
                step[a : a + n] = _piece_steps(single[a : a + n].tolist(), [(k, costs[a : a + n].tolist()) for k, costs in longer])
            _all_steps(step, first[few:] + pieces[few:], pieces[few:], single, longer)
        at, forced = first, begins.copy()
        while len(at):  # one word after another of all pieces at once
            at = at + step[at]
            at = at[~forced[at]]
            begins[at] = True
        at = np.flatnonzero(begins[:-1])
        return at, step[at]

    def counts(self, points: np.ndarray, at: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> Iterator[tuple[list[str], np.ndarray]]:
        """The distinct words among those that begin ``at`` the characters, with their sums of weights."""
        for k in np.unique(sizes).tolist():
            begin, weight = at[sizes == k], weights[sizes == k]
            state = points[begin].astype(np.int64) if k == 1 else self.dense[points[begin]]
            for j in range(2, k + 1):
                state = self._next(j, state, self.dense[points[begin + j - 1]])
            known, found = np.unique(state, return_inverse=True)
            sums = np.zeros(len(known), np.int64)
            np.add.at(sums, found.reshape(-1), weight)
            yield [chr(c) if k == 1 else self.levels[k - 2][2][c] for c in known.tolist()], sums


def _all_steps(step: np.ndarray, ends: np.ndarray, sizes: np.ndarray, single: np.ndarray, longer: Sequence[tuple[int, np.ndarray]]) -> None:
    """The size of the first word from every place of pieces, longest piece first: one place of all pieces at a time."""
    least = [np.zeros(len(ends), np.int64)]  # costs from the places after this one
    widest = max(k for k, _ in longer)
    alive = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), "right")
    for back, n in enumerate(alive.tolist(), 1):
        place = ends[:n] - back
        best, size = single[place] + least[0][:n], np.ones(n, np.int64)
        for k, costs in longer:
            if k > back:
                break
            cost = costs[place] + least[k - 1][:n]
            better = cost <= best
            best = np.where(better, cost, best)
            size[better] = k
        step[place] = size
        least = [best, *least[: widest - 1]]


def _piece_steps(single: Sequence[int], longer: Sequence[tuple[int, Sequence[int]]]) -> list[int]:
    """As :func:`_all_steps`, of one piece."""
    size = len(single)
    least, step = [0] * (size + 1), [1] * size
    for at in range(size - 1, -1, -1):
        best, length = least[at + 1] + single[at], 1
        for k, costs in longer:
            if at + k > size:
                break
            cost = costs[at] + least[at + k]
            if cost <= best:
                best, length = cost, k
        least[at], step[at] = best, length
    return step


def _cut(column: pa.Array, lattice: Lattice) -> Iterator[tuple[int, int, pa.Array]]:
    """The words of the runs of a column: a range of rows, and their lists of words."""
    raw, heads, points, bounds = _characters(column)
    for row, upto in _groups(bounds, CHUNK):
        low, high = int(bounds[row]), int(bounds[upto])
        own = bounds[row : upto + 1] - low
        at, _ = lattice.steps(points[low:high], own)
        bytes_at = heads[np.append(at, high - low) + low] - heads[low]
        data = pa.py_buffer(raw[heads[low] : heads[high]].tobytes())
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(bytes_at.astype(np.int32).tobytes()), data)
        yield row, upto, pa.ListArray.from_arrays(pa.array(np.searchsorted(at, own), pa.int32()), words)


def segmented(runs: DataFrame, lexicon: Lexicon, counted: bool = False) -> DataFrame:
    """``run, n, words`` — each run of ``run, n`` rows cut into words; ``counted``: ``token, n`` of those words, summed
    up to some degree within the tasks."""
    words, other, longest = lexicon.words, lexicon.other, lexicon.longest
    size = words.agg(F.count("word").alias("n"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")).first()
    if size["n"] <= MAX_WORDS and size["bytes"] <= MAX_BYTES:
        sent = runs.sparkSession.sparkContext.broadcast(vars(Lattice({r["word"]: r["cost"] for r in words.collect()}, other, longest)))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice.of(sent.value)
            for batch in batches:
                for row, upto, found in _cut(batch.column(0), lattice):
                    yield pa.RecordBatch.from_arrays([batch.column(0)[row:upto], batch.column(1)[row:upto], found], names=["run", "n", "words"])

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice.of(sent.value)
            for batch in batches:
                _, _, points, bounds = _characters(batch.column(0))
                n = batch.column(1).to_numpy(zero_copy_only=False)
                for row, upto in _groups(bounds, CHUNK):
                    low, own = int(bounds[row]), bounds[row : upto + 1] - bounds[row]
                    some = points[low : int(bounds[upto])]
                    at, sizes = lattice.steps(some, own)
                    weights = np.repeat(n[row:upto], np.diff(np.searchsorted(at, own)))
                    for tokens, sums in lattice.counts(some, at, sizes, weights):
                        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(sums)], names=["token", "n"])

        if counted:
            return runs.select("run", "n").mapInArrow(count, "token string, n bigint")
        return runs.select("run", "n").mapInArrow(cut, "run string, n bigint, words array<string>")

    def cut_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = {w["word"]: w["cost"] for own in batch.column(2).to_pylist() for w in own or ()}
            lattice = Lattice.of(vars(Lattice(costs, other, longest)))
            for row, upto, found in _cut(batch.column(0), lattice):
                yield pa.RecordBatch.from_arrays([batch.column(0)[row:upto], batch.column(1)[row:upto], found], names=["run", "n", "words"])

    numbered = _kept(runs.select("run", "n", F.monotonically_increasing_id().alias("_id")))
    at = numbered.select("_id", "run", F.explode(F.sequence(F.lit(1), F.char_length("run"))).alias("at"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest), F.char_length("run") - F.col("at") + 1))
    pieces = at.select("_id", F.explode(F.transform(lengths, lambda k: F.substr(F.col("run"), F.col("at"), k))).alias("word")).distinct()
    own = pieces.join(words, "word").groupBy("_id").agg(F.collect_list(F.struct("word", "cost")).alias("own"))  # no more than the run has substrings
    cut_rows = numbered.join(own, "_id", "left").select("run", "n", "own").mapInArrow(cut_with, "run string, n bigint, words array<string>")
    return cut_rows.select(F.explode("words").alias("token"), "n") if counted else cut_rows


def counted_runs(tokens: DataFrame, known: Column | None = None) -> DataFrame:
    """``run, n`` — the Han runs among ``token, n`` rows (``known``: whether a row is one, where that is known)."""
    return tokens.where(is_run(F.col("token")) if known is None else known).select(F.col("token").alias("run"), "n")


def word_counts(
    texts: DataFrame,
    text_col: str,
    stop: DataFrame | Sequence[str] | None = None,
    user_words: DataFrame | None = None,
    lexicon: Lexicon | None = None,
    **learning: int,
) -> DataFrame:
    """``token, n`` — word count of ``text_col`` with Han runs cut into words, by the given lexicon or one
    that is learned from the same texts (``learning``: parameters of :func:`learn`); stop words removed."""
    tokens = _kept(skills.word_counts(texts, text_col).withColumn("_run", is_run(F.col("token"))))
    runs = counted_runs(tokens, F.col("_run"))
    lexicon = learn(runs, user_words, **learning) if lexicon is None else lexicon
    words = segmented(runs, lexicon, counted=True)
    both = tokens.where(~F.col("_run")).select("token", "n").unionByName(words)
    if isinstance(stop, DataFrame):  # joined after the count, as the dictionary is
        return skills.without_stop_words(both.groupBy("token").agg(F.sum("n").alias("n")), stop)
    return skills.without_stop_words(both, stop).groupBy("token").agg(F.sum("n").alias("n"))
