"""Han segmentation: statistics and lattice against brute force, both ways to cut, the word-count job."""

import math
import random
from collections import Counter

import pyarrow as pa

from postlens.operators import segment
from postlens.plans import jobs
from postlens.sources.text import keyword_dictionary
from tests.conftest import plan_text
from tests.test_skills import counts, texts

HAN = "天地玄黄宇宙洪荒"


def random_runs(rng, n):
    words = ["天地", "玄黄宇", "宙", "洪荒天地", "黄宇", "荒"]
    return ["".join(rng.choice(words) if rng.random() < 0.8 else rng.choice(HAN) for _ in range(rng.randrange(1, 7))) for _ in range(n)]


def runs_frame(spark, runs):
    return spark.createDataFrame(sorted(Counter(runs).items()), "run string, n bigint")


def brute_statistics(runs, longest, min_count):
    count, before, after = Counter(), {}, {}
    for r, run in enumerate(runs):
        for at in range(len(run)):
            for k in range(1, longest + 1):
                if at + k <= len(run):
                    g = run[at : at + k]
                    count[g] += 1
                    # A run edge is a character of its own each time.
                    before.setdefault(g, Counter())[run[at - 1] if at else (r, at)] += 1
                    after.setdefault(g, Counter())[run[at + k] if at + k < len(run) else (r, at)] += 1
    total = sum(map(len, runs))
    entropy = lambda c: -sum(n / sum(c.values()) * math.log(n / sum(c.values())) for n in c.values())
    out = {}
    for g, n in count.items():
        if len(g) > 1 and n >= min_count:
            cohesion = min(math.log(n * total / (count[g[:k]] * count[g[k:]])) for k in range(1, len(g)))
            out[g] = (n, *(round(1000 * x) for x in (cohesion, entropy(before[g]), entropy(after[g]))))
    return out


def test_statistics_against_brute_force(spark):
    runs = random_runs(random.Random(1), 400)
    df = runs_frame(spark, runs)
    total = segment.characters(df).first()["total"]
    for longest, least in ((4, 5), (2, 2), (3, 40)):
        got = {r["word"]: tuple(r)[1:] for r in segment.word_statistics(segment.ngram_counts(df, longest + 1), total, longest, least).collect()}
        want = brute_statistics(runs, longest, least)
        assert got.keys() == want.keys() and all(max(abs(a - b) for a, b in zip(got[w], want[w])) <= 1 and got[w][0] == want[w][0] for w in want)


def brute_best(run, costs, other, longest):
    """All ways to cut: least cost, then the longest first word, and so on."""

    def cuts(rest):
        if not rest:
            yield ()
        for k in range(1, min(longest, len(rest)) + 1):
            if k == 1 or rest[:k] in costs:
                for more in cuts(rest[k:]):
                    yield (rest[:k], *more)

    return list(min(cuts(run), key=lambda ws: (sum(costs.get(w, other) for w in ws), [-len(w) for w in ws])))


def test_lattice_against_all_ways_to_cut():
    rng = random.Random(2)
    for _ in range(600):
        costs = {"".join(rng.choice(HAN[:3]) for _ in range(rng.randrange(1, 5))): rng.randrange(0, 6) for _ in range(8)}
        run = "".join(rng.choice(HAN[:4]) for _ in range(rng.randrange(0, 9)))
        assert segment.best_words(run, costs, 4, 4) == brute_best(run, costs, 4, 4)


def test_sent_and_joined_lexicons_cut_alike(spark, monkeypatch):
    df = runs_frame(spark, random_runs(random.Random(3), 300))
    lexicon = segment.learn(df, min_count=3)
    sent = segment.segmented(df, lexicon)
    monkeypatch.setattr(segment, "MAX_BYTES", 10)
    joined = segment.segmented(df, lexicon)
    assert "Join" not in plan_text(sent) and "Join" in plan_text(joined)
    rows = sorted(map(tuple, sent.collect()))
    assert rows == sorted(map(tuple, joined.collect())) and all("".join(words) == run for run, _, words in rows)
    assert any(len(w) > 1 for _, _, words in rows for w in words)


def test_learned_words_cut_sentences(spark):
    # Words in free order, without spaces: they are found again.
    rng = random.Random(4)
    words = ["天地", "玄黄宇", "宙洪", "荒日", "月盈昃辰"]
    df = texts(spark, *["".join(rng.choice(words) for _ in range(rng.randrange(2, 9))) + "，ok Ok" for _ in range(500)])
    got = counts(segment.word_counts(df, "skills", ["x"]))
    assert set(got) == {*words, "ok"} and got["ok"] == 1000


def test_user_words_of_any_length_and_stop_words(spark):
    df = texts(spark, "熟悉数据挖掘及分布式计算引擎", "熟悉算法的", None, "")
    own = keyword_dictionary(spark, words=["数据挖掘", "分布式计算引擎", "熟悉", "不出现", "java", "法"])
    got = counts(segment.word_counts(df, "skills", ["的"], own))
    assert got == {"熟悉": 2, "数据挖掘": 1, "及": 1, "分布式计算引擎": 1, "算": 1, "法": 1}
    assert counts(segment.word_counts(df, "skills", keyword_dictionary(spark, words=["的"]), own)) == got


def test_texts_without_han_and_empty_tables(spark):
    assert counts(segment.word_counts(texts(spark, "only ascii words"), "skills")) == {"only": 1, "ascii": 1, "words": 1}
    assert counts(segment.word_counts(spark.createDataFrame([], "skills string"), "skills")) == {}
    assert counts(segment.word_counts(texts(spark, "天"), "skills")) == {"天": 1}


def test_word_count_job_cuts_han_runs(spark, tmp_path):
    row = "\t".join(["1", "t", "c", "s", "1-2", "a", "b", "c", "d", "e", "熟悉数据挖掘 Java"])
    (tmp_path / "in.txt").write_text(row + "\n" + row + "\n")
    (tmp_path / "own.dic").write_text("数据挖掘\n熟悉\n")
    jobs.word_count_job(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), segmented=True, dictionary_path=str(tmp_path / "own.dic"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["(java,2)", "(数据挖掘,2)", "(熟悉,2)"]


def test_one_window_a_place_in_chunks_of_any_size(spark, monkeypatch):
    runs = [*random_runs(random.Random(8), 60), "天地玄黄宇宙洪荒" * 9, "\U00020000天\U00020000天"]
    df = runs_frame(spark, runs).coalesce(1)
    want = Counter(run[at : at + k] for run in runs for k in range(1, 7) for at in range(len(run) - k + 1))
    for chunk in (5, 64, 1 << 21):  # runs beyond a chunk are cut
        monkeypatch.setattr(segment, "CHUNK", chunk)
        assert segment._windows(df, 6).groupBy().sum("n").first()[0] == sum(map(len, runs))
        got = {r["gram"]: r["n"] for r in segment.ngram_counts(df, 6).collect()}
        assert got == {g: n for g, n in want.items() if n > 1}
    many = ["".join(map(chr, range(0x4E00, 0x4E00 + 20000))) + "天地天地"] * 2  # too many characters for one code a window
    got = {r["gram"]: r["n"] for r in segment.ngram_counts(runs_frame(spark, many), 6).collect()}
    assert got == {g: n for g, n in Counter(run[at : at + k] for run in many for k in range(1, 7) for at in range(len(run) - k + 1)).items() if n > 1}


def test_many_runs_are_cut_at_once_as_each_alone(spark, monkeypatch):
    rng = random.Random(9)
    letters = HAN[:5] + "\U00020000"
    for longest in (1, 2, 4, 7):
        costs = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, longest + 2))): rng.randrange(0, 9) for _ in range(40)}
        runs = ["".join(rng.choice(letters + "X") for _ in range(rng.choice([0, 1, 2, 9, 40, 300]))) for _ in range(200)]
        want = [segment.best_words(run, costs, 6, longest) for run in runs]
        for table, few, chunk in ((1 << 20, 16, 1 << 21), (0, 1, 50), (1 << 20, 1000, 400)):  # keys searched, pieces one by one, groups of rows
            monkeypatch.setattr(segment.Lattice, "TABLE", table)
            monkeypatch.setattr(segment.Lattice, "FEW", few)
            monkeypatch.setattr(segment, "CHUNK", chunk)
            lattice = segment.Lattice.of(vars(segment.Lattice(costs, 6, longest)))
            column = pa.array(["前", *runs], pa.string())[1:]  # a column that begins within its buffers
            assert [words for _, _, found in segment._cut(column, lattice) for words in found.to_pylist()] == want


def test_counted_words_are_those_of_the_cut_runs(spark, monkeypatch):
    runs = [*random_runs(random.Random(10), 300), "天地" * 500 + "丁", "丙"]
    df = runs_frame(spark, runs)
    lexicon = segment.learn(df, min_count=3)
    want = Counter(w for _, n, words in segment.segmented(df, lexicon).collect() for w in words for _ in range(n))
    for most in (segment.MAX_BYTES, 10):  # sent and joined
        monkeypatch.setattr(segment, "MAX_BYTES", most)
        got = Counter()
        for r in segment.segmented(df, lexicon, counted=True).collect():
            got[r["token"]] += r["n"]
        assert got == want and {"丁", "丙"} <= set(got)
    monkeypatch.undo()
    assert "Generate" not in plan_text(segment.segmented(df, lexicon, counted=True))  # no row for each word of a run
