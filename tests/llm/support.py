"""Small inputs and brute-force helpers of the operator tests."""

import os
import re

SF = "/root/testdata/sf0.001"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def write_tables(spark, path, **tables):
    """Writes (rows, schema) pairs as the tables of a scale folder."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(path, f"{name}.parquet"))
    return str(path)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, len(text or ""))


#: Texts that every document operator must survive.
ODD = [None, "", " ", "\n\t", "a", "ünïcödé 漢字 😀", "x" * 5000, "w " * 3000, "a  b\n\n c", "<|endoftext|>", "\\", "same text here"]
