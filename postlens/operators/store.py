"""Result store: versioned cells in an append-only parquet table.

A cell is ``(row_key, family, qualifier, value, version)``, the wide-row model of the reference's
sink. A write is one run of one job and goes to ``job=<name>/run=<id>`` with ``overwrite``:
replaying a run replaces that run alone, and jobs that share a store never touch each other's
cells. The run id is the version of its cells; :func:`new_run` hands out the next number of the
store, each once. Reads resolve "last write wins" with ``max_by(value, version)``, a distributed
aggregate with partial aggregation, so a hot row key is reduced map-side.

:func:`compact` keeps reads cheap after thousands of runs: it writes the newest cells of each job,
clustered by row key, as a *snapshot* that stands for all runs up to some id, and then a pointer file
``_snapshots/<number>``, created only if there is none of that name. Readers take the pointer with the
largest number, its snapshot and the runs after it. Nothing they may have listed before is changed: a
compaction that dies before its pointer leaves a folder that nobody reads, and :func:`vacuum`
removes only what the pointer before the newest has made needless. Rows of a compacted store are
found by key ranges (:func:`rows_between`, :func:`rows_with_prefix`): files hold ranges of row keys
in order, so the scan skips what can't hold the range.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import fs
from postlens.functions.jsonfmt import CHUNK_ENTRIES, chunked

CELL_COLUMNS = ["row_key", "family", "qualifier", "value", "version"]
CELL_SCHEMA = "row_key string, family string, qualifier string, value string, version bigint"


def as_cells(df: DataFrame, row_key, family, qualifier, value, version) -> DataFrame:
    """Project any DataFrame to the cell layout; arguments are column names or Columns."""

    def c(x):
        return F.col(x) if isinstance(x, str) else x

    return df.select(
        c(row_key).cast("string").alias("row_key"),
        c(family).cast("string").alias("family"),
        c(qualifier).cast("string").alias("qualifier"),
        c(value).cast("string").alias("value"),
        c(version).cast("bigint").alias("version"),
    )


def new_run(spark: SparkSession, store: str) -> int:
    """The next run id of a store: larger than all before, whichever job asks. Its mark is created
    only if there is none yet, so two drivers never get the same one."""
    root = store.rstrip("/")
    while True:
        taken = [int(n) for n in fs.children(spark, f"{root}/_runs")]
        run = max([*taken, *(r for _, r, _ in runs(spark, root)), _snapshot(spark, root)[1]], default=-1) + 1
        if fs.write_new(spark, f"{root}/_runs/{run}", ""):
            return run


def run_path(store: str, job: str, run: int) -> str:
    return f"{store.rstrip('/')}/job={job}/run={run}"


def runs(spark: SparkSession, store: str) -> list[tuple[str, int, bool]]:
    """(job, run, whether its write has finished) of every run in a store."""
    out = []
    for job in (n[4:] for n in fs.children(spark, store) if n.startswith("job=")):
        for name in fs.children(spark, f"{store.rstrip('/')}/job={job}"):
            if name.startswith("run="):
                out.append((job, int(name[4:]), fs.exists(spark, f"{run_path(store, job, int(name[4:]))}/_SUCCESS")))
    return out


def _pointers(spark: SparkSession, store: str) -> list[int]:
    return sorted(int(n) for n in fs.children(spark, f"{store}/_snapshots") if n.isdigit())


def _snapshot(spark: SparkSession, store: str, number: int | None = None) -> tuple[str | None, int]:
    """(folder of the snapshot's cells, last run id it stands for) of the newest or the given pointer; (None, -1) without one."""
    known = _pointers(spark, store)
    if not known:
        return None, -1
    folder, _, upto = fs.read_text(spark, f"{store}/_snapshots/{known[-1] if number is None else number}").partition(" ")
    return f"{store}/_snapshots/{folder}/cells", int(upto)


def write_cells(cells: DataFrame, store: str, job: str, run: int) -> str:
    """Writes ``cells`` as run ``run`` of ``job`` (a rewrite replaces that run). A run that a snapshot
    stands for can't be written any more."""
    upto = _snapshot(cells.sparkSession, store.rstrip("/"))[1]
    if run <= upto:
        raise ValueError(f"run {run} is part of a snapshot of the runs up to {upto}: write a new run")
    path = run_path(store, job, run)
    cells.select(*CELL_COLUMNS).write.mode("overwrite").parquet(path)
    return path


def read_cells(spark: SparkSession, store: str, job: str | None = None, run: int | None = None) -> DataFrame:
    """The cells of a store with the columns ``job`` and ``run``: those of its snapshot and of all runs
    after it (without a snapshot, all cells ever written); or those of one job or run."""
    root = store.rstrip("/")
    schema = CELL_SCHEMA + ", job string, run bigint"
    reader = spark.read.schema(schema).option("basePath", store)
    if job is not None and run is not None:
        return reader.parquet(run_path(store, job, run))
    folder, upto = _snapshot(spark, root)
    if folder is None:
        return reader.parquet(root if job is None else f"{root}/job={job}")
    cells = spark.read.schema(schema).parquet(folder)
    later = [run_path(root, j, r) for j, r, done in runs(spark, root) if done and r > upto and job in (None, j)]
    if later:
        cells = cells.unionByName(reader.parquet(*later))
    return cells if job is None else cells.where(F.col("job") == job)


def compact(spark: SparkSession, store: str, upto: int | None = None) -> int | None:
    """Writes a snapshot of the newest cells of each job from the runs up to ``upto``; returns its last run id.

    By default it stands for all runs before the first one that has begun but not finished (an abandoned
    run holds it up until ``upto`` passes it by, and then can't be written any more). None if there is
    nothing new, or another compaction came first.
    """
    root = store.rstrip("/")
    known = runs(spark, root)
    finished = {r for _, r, done in known if done}
    before = _snapshot(spark, root)[1]
    if upto is None:
        begun = {int(n) for n in fs.children(spark, f"{root}/_runs")} - {r for _, r, _ in known}
        begun |= {r for _, r, done in known if not done}
        open_runs = [r for r in begun if r > before]
        upto = max([r for r in finished if not open_runs or r < min(open_runs)], default=-1)
    if upto <= before or not any(before < r <= upto for r in finished):
        return None
    number = max(_pointers(spark, root), default=-1) + 1
    cells = read_cells(spark, root).where(F.col("run") <= upto)
    newest = cells.groupBy("job", "row_key", "family", "qualifier").agg(
        F.max_by("value", F.struct("version", "run")).alias("value"), F.max("version").alias("version"), F.max_by("run", F.struct("version", "run")).alias("run")
    )
    made = f"data-{uuid.uuid4().hex[:12]}"
    order = ["job", "row_key", "family", "qualifier"]
    newest.select(*CELL_COLUMNS, "run", "job").repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("job").parquet(f"{root}/_snapshots/{made}/cells")
    return upto if fs.write_new(spark, f"{root}/_snapshots/{number}", f"{made} {upto}") else None


def vacuum(spark: SparkSession, store: str) -> list[str]:
    """Removes the runs that the pointer before the newest stands for, older snapshots, and folders that
    no pointer names. Readers that began before the newest pointer still find all that they listed.
    No compaction may be under way."""
    root = store.rstrip("/")
    known = _pointers(spark, root)
    if len(known) < 2:
        return []
    kept = {_snapshot(spark, root, n)[0] for n in known[-2:]}
    covered = _snapshot(spark, root, known[-2])[1]
    gone = [run_path(root, j, r) for j, r, _ in runs(spark, root) if r <= covered]
    gone += [f"{root}/_runs/{n}" for n in fs.children(spark, f"{root}/_runs") if int(n) <= covered]
    gone += [f"{root}/_snapshots/{n}" for n in known[:-2]]
    gone += [f"{root}/_snapshots/{n}" for n in fs.children(spark, f"{root}/_snapshots") if n.startswith("data-") and f"{root}/_snapshots/{n}/cells" not in kept]
    for path in gone:
        fs.delete(spark, path)
    return gone


def rows_between(cells: DataFrame, start: str, stop: str | None = None) -> DataFrame:
    """Cells whose row key is at or after ``start`` and before ``stop`` (by UTF-8 bytes; None: no end)."""
    found = cells.where(F.col("row_key") >= start)
    return found if stop is None else found.where(F.col("row_key") < stop)


def rows_with_prefix(cells: DataFrame, prefix: str) -> DataFrame:
    """Cells whose row key begins with ``prefix``."""
    return cells.where(F.col("row_key").startswith(prefix))


def latest(cells: DataFrame) -> DataFrame:
    """``row_key, family, qualifier, value, version`` — the newest value of each cell."""
    return cells.groupBy("row_key", "family", "qualifier").agg(
        F.max_by("value", "version").alias("value"), F.max("version").alias("version")
    )


def pivot(cells: DataFrame, qualifiers: Sequence[str], family: str | None = None) -> DataFrame:
    """One row per ``row_key`` with the newest value of each qualifier in a column of its own (the
    read-back of a wide row).

    Works on raw or latest cells: newest value and pivot are one aggregate, with one shuffle.
    """
    df = cells if family is None else cells.where(F.col("family") == family)
    newest = [F.max_by("value", F.when(F.col("qualifier") == q, F.col("version"))).alias(q) for q in qualifiers]
    return df.where(F.col("qualifier").isin(list(qualifiers))).groupBy("row_key").agg(*newest)


def as_text(latest_cells: DataFrame, family: str | None = None, entries: int = CHUNK_ENTRIES) -> DataFrame:
    """``row_key, chunk, text`` — ``qualifier:value`` pairs of a row, tab-separated, by qualifier.

    A row of up to ``entries`` cells is one text, chunk 0; a wider one is dealt into several by hash of
    the qualifier, so that no text grows with the number of qualifiers.
    """
    df = latest_cells if family is None else latest_cells.where(F.col("family") == family)
    cells = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
    text = F.array_join(F.transform(cells, lambda e: F.concat(e["qualifier"], F.lit(":"), e["value"])), "\t")
    return chunked(df, ["row_key"], "qualifier", entries).groupBy("row_key", "chunk").agg(text.alias("text"))


def glob_regex(pattern: str) -> str:
    """Glob (``*``, ``?``) to an anchored Java regex."""
    out = []
    for ch in pattern:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        else:
            out.append(re.escape(ch))
    return "(?s)^" + "".join(out) + "\\z"  # (?s): a glob * also matches line breaks


def keys(cells: DataFrame, pattern: str = "*") -> DataFrame:
    """``row_key`` — distinct keys matching a glob pattern (the key listing, S9)."""
    df = cells.select("row_key")
    if pattern != "*":
        df = df.where(F.col("row_key").rlike(glob_regex(pattern)))
    return df.distinct()
