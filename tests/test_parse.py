"""Ragged-line micro-fixture (FIXTURES 2): field counts and gates."""

from postlens.functions.parse import gate, postings

ROWS = [
    ("1|t|c|d|5000-8000|北京|民营|20-99人|1-3年|本科|熟悉 Spark", 11),
    ("2|t|c|d|5000-8000|北京|民营|20-99人|1-3年|本科|", 10),
    ("3|t|c|d|5000-8000|北京|民营|20-99人|1-3年||", 9),
    ("4|t|c|d|面议", 5),
    ("5|t|c|d|", 4),
    ("6|t|c|d|5000-8000||民营||1-3年|本科|x", 11),
    ("7|t|c|d|1-2|a|b|c|d|e|f|g", 12),
]


def lines(spark):
    return spark.createDataFrame([(r[0],) for r in ROWS], "value string")


def test_field_counts_drop_trailing_empty_fields(spark):
    got = {r["salary"] if r["n_fields"] != 4 else "short": r["n_fields"] for r in postings(lines(spark)).collect()}
    counts = sorted(r["n_fields"] for r in postings(lines(spark)).collect())
    assert counts == sorted(r[1] for r in ROWS)
    assert got["short"] == 4


def test_gates(spark):
    p = postings(lines(spark))
    assert gate(p, min_fields=5).count() == 6
    assert gate(p, min_fields=10).count() == 4
    assert gate(p, exact=11).count() == 2
    assert gate(p, above=10).count() == 3


def test_short_rows_have_null_fields_not_errors(spark):
    p = postings(lines(spark)).where("n_fields = 4")
    row = p.collect()[0]
    assert row["salary"] is None and row["skills"] is None


def test_empty_fields_are_kept_inside_the_row(spark):
    r = postings(lines(spark)).where("n_fields = 11 AND address = ''").collect()
    assert len(r) == 1 and r[0]["company_size"] == "" and r[0]["skills"] == "x"


def test_tab_separator(spark):
    df = spark.createDataFrame([("a\tb\t\t",), ("a\tb\tc",)], "value string")
    got = sorted(r["n_fields"] for r in postings(df, sep="\t").collect())
    assert got == [2, 3]


def test_trailing_strip_is_end_of_text_only(spark):
    # Java's split keeps a field that is only a line-separator character; so must we.
    df = spark.createDataFrame([("a|b|\u2028",), ("a|b|",)], "value string")
    got = sorted(r["n_fields"] for r in postings(df).collect())
    assert got == [2, 3]


def java_split_count(line: str, sep: str = "|") -> int:
    """Number of fields Java's String.split gives (trailing empty fields removed)."""
    if line == "":
        return 1
    parts = line.split(sep)  # "|||" -> [] (no fields)
    while parts and parts[-1] == "":
        parts.pop()
    return len(parts)


def test_field_count_equals_java_split_model(spark):
    import random

    rnd = random.Random(13)
    atoms = ["", "|", "||", "a", "本科", " ", "5000-8000", "\t"]
    lines = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 14))) for _ in range(2000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = {r["id"]: r["n_fields"] for r in postings(df, id_col="i").collect()}
    for i, x in enumerate(lines):
        assert got[i] == java_split_count(x), repr(x)


def test_rebalanced_read_keeps_every_line(spark, tmp_path):
    import gzip

    from postlens.sources.text import read_postings

    path = str(tmp_path / "postings.txt.gz")
    with gzip.open(path, "wt", encoding="utf-8") as fh:
        fh.write("\n".join(r[0] for r in ROWS * 50) + "\n")
    plain = read_postings(spark, path)
    balanced = read_postings(spark, path, rebalance=True)
    assert plain.rdd.getNumPartitions() == 1  # gzip cannot be split
    assert sorted(map(tuple, balanced.collect())) == sorted(map(tuple, plain.collect()))
    assert "RebalancePartitions" in balanced._jdf.queryExecution().optimizedPlan().toString()
