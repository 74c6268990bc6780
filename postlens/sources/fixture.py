"""Posting lines derived by Spark from the TPC-H-style tables (FIXTURES.md section 1).

One line per ``orders`` row joined to its customer and nation. Field values follow fixed rules on
the order key ``k``, so the same lines can be built in SQL on another engine for oracle checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A driver table, pruned to ``columns``, with the partitions of its scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _by_mod(k: Column, m: int, values: list) -> Column:
    """``values[k % m]``; entries are literals or columns."""
    r = k % m
    out = None
    for i, v in enumerate(values):
        val = v if isinstance(v, Column) else F.lit(v)
        out = F.when(r == i, val) if out is None else out.when(r == i, val)
    return out


def posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id BIGINT, line STRING)`` — ``orders ⋈ customer ⋈ nation``, one posting per order.

    ``customer`` is joined on the key without a hint: AQE chooses a broadcast at small scale and a
    sort-merge join (with skew splitting) when the customer table is large. ``nation`` has no
    hint either: the planner broadcasts it by its size in bytes.
    """
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    customer = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    nation = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet").select("n_nationkey", "n_name")

    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )

    k = F.col("o_orderkey")
    lo = F.floor(F.col("o_totalprice") / 12).cast("int").cast("string")
    hi = F.floor(F.col("o_totalprice") / 8).cast("int").cast("string")

    salary = (
        F.when(k % 10 == 0, F.lit("面议"))
        .when(k % 10 == 1, F.lit("1000元以下"))
        .when(k % 10 == 2, F.lit(""))
        .when(k % 10 == 3, F.concat(lo, F.lit("-"), hi, F.lit("元/月")))
        .when(k % 10 == 4, F.concat(F.lit("-"), hi))
        .when(k % 10 == 5, F.concat(lo, F.lit("-")))
        .otherwise(F.concat(lo, F.lit("-"), hi))
    )
    address = F.when(k % 7 == 0, F.lit("")).otherwise(F.col("n_name"))
    experience = _by_mod(k, 4, ["1-3年", "3-5年", "不限", ""])
    education = F.when(k % 23 == 0, F.lit("")).otherwise(_by_mod(k, 3, ["本科", "大专", "硕士"]))
    word = _by_mod(k, 5, ["Hadoop", "spark", "java", "javascript", "MySQL"])
    topic = _by_mod(k, 2, ["数据挖掘", "算法"])
    skills = F.when(k % 11 == 0, F.lit("")).otherwise(
        F.concat(F.lit("Need "), word, F.lit(", 熟悉"), topic, F.lit("及Linux"))
    )

    short = k % 17 == 0              # stops after position 2
    mid = (~short) & (k % 13 == 0)   # stops after position 4

    def upto(pos: int, c: Column) -> Column:
        if pos <= 2:
            return c
        if pos <= 4:
            return F.when(~short, c)
        return F.when(~short & ~mid, c)

    fields = [
        k.cast("string"),
        F.lit("job"),
        F.col("c_name"),
        upto(3, F.col("o_orderstatus")),
        upto(4, salary),
        upto(5, address),
        upto(6, F.col("c_mktsegment")),
        upto(7, F.col("o_orderpriority")),
        upto(8, experience),
        upto(9, education),
        upto(10, skills),
    ]
    return joined.select(k.alias("id"), F.concat_ws("|", *fields).alias("line"))
