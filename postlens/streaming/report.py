"""Streaming report (C4, T1-T10): running salary histograms, skill counts and dimension counts.

One streaming query serves all four outputs. Each posting is exploded to ``(metric, dim, key)``
rows, and a single ``groupBy(metric, dim, key).count()`` keeps the running totals in one state
store (RocksDB when configured). Keys never expire, as in the reference. The default output mode
is ``update``, so each micro-batch emits only the keys it changed: with unbounded keys (addresses,
tokens) a batch costs what it touched, not the whole state.

The sink is ``foreachBatch`` into ``run=<r>/delta=<batch>`` with ``overwrite``, so a replayed batch
replaces itself (exactly-once with the checkpoint). A run belongs to a checkpoint: a query that
starts on a new checkpoint opens a new run, and readers take the newest run, so totals of an
earlier life never mask it. Every ``full_every`` batches the sink writes the newest value of every
cell as ``full=<batch>`` and removes what the full view before that has made needless: a reader
opens one full view and the deltas after it, however long the query has run.

JSON documents can be kept up in the same mode (``json_store``): a batch reads the documents that its changed
cells fall into, merges the cells and writes these documents alone. The keys of a section are dealt over
documents by hash, over twice as many once it has outgrown them; then, and only then, a batch writes all
documents of the section.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlens import fs, schema
from postlens.functions.jsonfmt import CHUNK_ENTRIES, chunk_name, chunk_of, chunked, doubled, envelope, nested_map, sorted_map
from postlens.functions.parse import postings
from postlens.functions.text import keyword_tokens
from postlens.operators import store
from postlens.operators.skills import Needs, broadcastable, dictionary_needs
from postlens.plans.cells import explode_cells, keep_dictionary_tokens, with_bucket_labels

SALARY_FLOOR = "salary_floor"
SALARY_CEILING = "salary_ceiling"
SKILLS = "skills"
OTHER = "other"
ALL_METRICS = (SALARY_FLOOR, SALARY_CEILING, SKILLS, OTHER)

# Result key suffix of each metric ("<job>:<section>").
SECTIONS = {
    SALARY_FLOOR: schema.SECTION_SALARY_FLOOR,
    SALARY_CEILING: schema.SECTION_SALARY_CEILING,
    SKILLS: schema.SECTION_SKILLS,
    OTHER: schema.SECTION_OTHER,
}


def stream_rows(
    posts: DataFrame,
    dictionary: DataFrame,
    needs: Needs,
    grid: Sequence[int] = schema.STREAM_GRID,
    metrics: Sequence[str] = ALL_METRICS,
) -> DataFrame:
    """``metric, dim, key`` — the counted cells of each posting (batch or stream input)."""
    ge5 = F.col("n_fields") >= schema.GATE_STREAM_SALARY
    full = F.col("n_fields") == schema.GATE_FULL
    dims = [d[0] for d in schema.DIMENSIONS]
    carry = ["n_fields", *dims, "_tok"]

    tokens = F.when(full, keyword_tokens("skills", needs)).alias("_tok")
    base = with_bucket_labels(posts.select(*carry[:-1], "salary", tokens), grid, True, carry)

    fixed: list[tuple[tuple[str, str], Column]] = []
    if SALARY_FLOOR in metrics:
        fixed.append(((SALARY_FLOOR, ""), F.when(ge5, F.col("_b0"))))
    if SALARY_CEILING in metrics:
        fixed.append(((SALARY_CEILING, ""), F.when(ge5, F.col("_b1"))))
    if OTHER in metrics:
        fixed += [((OTHER, label), F.when(full & (F.col(c) != ""), F.col(c))) for c, _, label in schema.DIMENSIONS]
    with_skills = SKILLS in metrics
    rows = explode_cells(base, ["metric", "dim"], fixed, F.col("_tok") if with_skills else None, (SKILLS, ""))
    if not with_skills:
        return rows
    return keep_dictionary_tokens(rows, dictionary, "metric", SKILLS, ["metric", "dim", "key"], broadcastable(dictionary))


def running_counts(rows: DataFrame) -> DataFrame:
    """``metric, dim, key, n`` — the running total of each cell (stateful when streaming)."""
    return rows.groupBy("metric", "dim", "key").agg(F.count(F.lit(1)).alias("n"))


def counts_as_cells(counts: DataFrame, version: Column) -> DataFrame:
    return store.as_cells(counts, "metric", "dim", "key", F.col("n").cast("string"), version)


def as_totals(cells: DataFrame) -> DataFrame:
    """``metric, dim, key, n`` of stored cells."""
    return cells.select(
        F.col("row_key").alias("metric"),
        F.col("family").alias("dim"),
        F.col("qualifier").alias("key"),
        F.col("value").cast("bigint").alias("n"),
    )


def _run_of(spark: SparkSession, checkpoint: str, store_path: str) -> int:
    """The run that belongs to a checkpoint: noted in it, or the next of the store if it is new."""
    note = f"{checkpoint.rstrip('/')}/postlens-run"
    if fs.exists(spark, note):
        return int(fs.read_text(spark, note))
    run = max([int(n[4:]) for n in fs.children(spark, store_path) if n.startswith("run=")], default=-1) + 1
    fs.write_text(spark, note, str(run))
    return run


def _parts(spark: SparkSession, run_path: str, before: int | None = None) -> tuple[int, list[int], list[int]]:
    """(newest full view or -1, deltas after it, what is older) of a run (of batches before ``before``);
    unfinished writes don't count."""
    done = [n for n in fs.children(spark, run_path) if fs.exists(spark, f"{run_path}/{n}/_SUCCESS")]
    done = [n for n in done if before is None or int(n.partition("=")[2]) < before]
    fulls = sorted(int(n[5:]) for n in done if n.startswith("full="))
    deltas = sorted(int(n[6:]) for n in done if n.startswith("delta="))
    newest = fulls[-1] if fulls else -1
    return newest, [d for d in deltas if d > newest], fulls[:-1]


def _view(spark: SparkSession, run_path: str, before: int | None = None) -> DataFrame:
    """The cells of a run's newest full view and the deltas after it (of batches before ``before``)."""
    newest, deltas, _ = _parts(spark, run_path, before)
    paths = ([f"{run_path}/full={newest}"] if newest >= 0 else []) + [f"{run_path}/delta={d}" for d in deltas]
    reader = spark.read.schema(store.CELL_SCHEMA)
    return reader.parquet(*paths) if paths else spark.createDataFrame([], store.CELL_SCHEMA)


def _write_full(spark: SparkSession, cells: DataFrame, run_path: str, batch_id: int) -> None:
    """Writes a full view and removes what came before the full view before it, which readers
    that began earlier may still read and a replay of the batch reads again."""
    previous = _parts(spark, run_path, before=batch_id)[0]
    cells.select(*store.CELL_COLUMNS).write.mode("overwrite").parquet(f"{run_path}/full={batch_id}")
    for name in fs.children(spark, run_path):
        kind, _, number = name.partition("=")
        if kind == "full" and int(number) < previous or kind == "delta" and int(number) <= previous:
            fs.delete(spark, f"{run_path}/{name}")


def start(
    spark: SparkSession,
    lines: DataFrame,
    dictionary: DataFrame,
    store_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str | None = None,
    metrics: Sequence[str] = ALL_METRICS,
    grid: Sequence[int] = schema.STREAM_GRID,
    echo: bool = False,
    state_partitions: int | None = None,
    json_store: str | None = None,
    job: str = "job",
    full_every: int = 20,
    json_entries: int = CHUNK_ENTRIES,
) -> StreamingQuery:
    """Starts the streaming report over a stream of posting lines (``value`` column).

    ``trigger`` defaults to a 10-second processing-time trigger (the reference's batch interval);
    pass ``{"availableNow": True}`` to drain the input and stop. ``echo`` also prints each
    batch's changed totals (the console output of the reference).

    ``state_partitions`` sets the number of state-store partitions of a NEW query (a restarted
    query keeps the count recorded in its checkpoint). The stream copies the session settings when
    it starts, so the session's own shuffle-partition setting is restored right after.

    ``json_store``: after each batch also write the ``<job>:<section>`` JSON documents as cells
    ``(key, 'kv', 'value', json, batch_id)``, the per-batch key→JSON upsert of the reference. With
    ``output_mode="update"`` a batch writes the documents that it changed (see :func:`changed_documents`), which is
    the mode for wide state. By default such a query runs in ``complete`` mode: the state that the batch
    emits gives all documents, and nothing written earlier is read again. ``stored_documents`` reads either.
    ``json_entries``: the keys of a section that a document holds, on average, at most.

    One query at a time writes to a store path.
    """
    needs = dictionary_needs(dictionary) if SKILLS in metrics else {}
    counts = running_counts(stream_rows(postings(lines, "value"), dictionary, needs, grid, metrics))
    mode = output_mode or ("complete" if json_store is not None else "update")
    run_path = f"{store_path.rstrip('/')}/run={_run_of(spark, checkpoint, store_path)}"
    json_path = f"{json_store.rstrip('/')}/{run_path.rpartition('/')[2]}" if json_store is not None else None

    def sink(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        keeps = json_path is not None and mode != "complete"
        reused = echo or json_path is not None and not keeps  # computed once for several uses
        if reused:
            batch = batch.persist()
        try:
            cells = counts_as_cells(batch, F.lit(batch_id))
            if mode == "complete":
                _write_full(session, cells, run_path, batch_id)
            elif (batch_id + 1) % full_every == 0 and not keeps:
                _write_full(session, store.latest(_view(session, run_path, before=batch_id).unionByName(cells)), run_path, batch_id)
            else:
                cells.write.mode("overwrite").parquet(f"{run_path}/delta={batch_id}")
            if keeps:
                # From the written cells: the batch's own plan would load its state again for every use.
                changed = as_totals(session.read.schema(store.CELL_SCHEMA).parquet(f"{run_path}/delta={batch_id}"))
                _write_documents(session, changed, json_path, job, batch_id, False, full_every, json_entries)
                if (batch_id + 1) % full_every == 0:
                    _write_full(session, store.latest(_view(session, run_path, before=batch_id + 1)), run_path, batch_id)
            elif json_path is not None:
                _write_documents(session, batch, json_path, job, batch_id, True, full_every, json_entries)
            if echo:
                batch.show(10, truncate=False)
        finally:
            if reused:
                batch.unpersist()

    writer = (
        counts.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    if state_partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, previous)


SIZES_SCHEMA = "metric string, dim string, keys bigint, chunks bigint"
#: Documents that the scan looks up by name; more are found by a join.
NAMED_DOCUMENTS = 1000


def _document_name(job: str, metric: Column, chunk: Column) -> Column:
    return chunk_name(F.concat(F.lit(f"{job}:"), F.create_map(*[x for m, s in SECTIONS.items() for x in (F.lit(m), F.lit(s))])[metric]), chunk)


def _document_cells(documents: DataFrame, job: str) -> DataFrame:
    """``metric, dim, key, n`` in documents of a job, whose name may hold any character."""
    parsed = _parsed(documents.select(F.concat(F.lit("j:"), F.expr(f"substring(key, {len(job) + 2})")).alias("key"), "value"))
    # One that can't be read must not be replaced by one without its totals. The error hangs on ``good``
    # in one expression, as filters may be evaluated in any order.
    failed = F.raise_error(F.concat(F.lit("document can't be read: "), F.substring("value", 1, 200)))
    cells = _exploded(parsed.withColumn("inner", F.when(F.col("good"), F.col("inner")).otherwise(failed)))
    metric = F.create_map(*[x for m, s in SECTIONS.items() for x in (F.lit(s), F.lit(m))])[F.col("section")]
    return cells.select(metric.alias("metric"), "dim", "key", "n")


def _addressed(cells: DataFrame, sizes: dict[tuple[str, str], tuple[int, int]]) -> DataFrame:
    """``cells`` with the ``chunk`` that they have in sections of those sizes."""
    chunks = F.lit(1).cast("bigint")
    for (metric, dim), (_, number) in sizes.items():
        if number > 1:
            chunks = F.when((F.col("metric") == metric) & (F.col("dim") == dim), F.lit(number).cast("bigint")).otherwise(chunks)
    return cells.withColumn("chunk", chunk_of("key", chunks))


def changed_documents(changed: DataFrame, documents: DataFrame, sizes: DataFrame, job: str, entries: int = CHUNK_ENTRIES) -> tuple[DataFrame, DataFrame]:
    """(``key, value`` of the documents that differ once ``changed`` cells are merged in, the new sizes).

    ``changed``: ``metric, dim, key, n``, a row per cell. ``documents``: the stored ``key, value``.
    ``sizes``: ``metric, dim, keys, chunks``, of each section and dimension in them. Only the documents that
    the cells are dealt to are read and written, until a section has outgrown its chunks: then all
    documents of its metric are dealt anew, and one that is left without a cell has a NULL value.
    """
    cell = ["metric", "dim", "key"]
    changed = changed.select(*cell, "n")
    before = {(r["metric"], r["dim"]): (r["keys"], r["chunks"]) for r in sizes.collect()}  # a row per section and dimension
    names = _addressed(changed, before).select(_document_name(job, F.col("metric"), F.col("chunk")).alias("key")).distinct()
    few = [r["key"] for r in names.limit(NAMED_DOCUMENTS + 1).collect()]
    old = documents.where(F.col("key").isin(few)) if len(few) <= NAMED_DOCUMENTS else documents.join(names, "key", "left_semi")
    new = changed.join(_document_cells(old, job).select(*cell), cell, "left_anti").groupBy("metric", "dim").agg(F.count(F.lit(1)).alias("keys"))
    after = dict(before)
    for r in new.collect():
        group = r["metric"], r["dim"]
        keys, chunks = before.get(group, (0, 1))
        after[group] = keys + r["keys"], max(chunks, doubled(keys + r["keys"], entries))
    kept_sizes = changed.sparkSession.createDataFrame([(*g, *n) for g, n in sorted(after.items())], SIZES_SCHEMA)
    grown = sorted({g[0] for g, n in before.items() if after[g][1] != n[1]})
    whole = F.lit(False)
    for name in (f"{job}:{SECTIONS[m]}" for m in grown):
        whole = whole | (F.col("key") == name) | F.col("key").startswith(f"{name}#")
    if grown:
        old = documents.where(whole).unionByName(old.where(~whole))
    merged = _addressed(_document_cells(old, job).join(changed.select(*cell), cell, "left_anti").unionByName(changed), after)
    docs = _documents(merged, job)
    if grown:
        left = merged.select(_document_name(job, F.col("metric"), F.col("chunk")).alias("key")).distinct()
        docs = docs.unionByName(documents.where(whole).select("key", F.lit(None).cast("string").alias("value")).join(left, "key", "left_anti"))
    return docs, kept_sizes


def _write_documents(spark: SparkSession, batch: DataFrame, json_path: str, job: str, batch_id: int, complete: bool, full_every: int, entries: int) -> None:
    """Writes the documents of a batch: all as a full view, or those that changed as a delta. The sizes of the
    sections are kept by batch, so that a replayed batch begins from those of the batch before it."""

    def as_cells(docs: DataFrame) -> DataFrame:
        return store.as_cells(docs, "key", F.lit("kv"), F.lit("value"), "value", F.lit(batch_id))

    if complete:
        _write_full(spark, as_cells(json_documents(batch, job, entries=entries)), json_path, batch_id)
        return
    before, _, run = json_path.rpartition("run=")
    folder = f"{before}sizes={run}"
    known = sorted(int(n[6:]) for n in fs.children(spark, folder) if fs.exists(spark, f"{folder}/{n}/_SUCCESS"))
    earlier = [b for b in known if b < batch_id]
    documents = store.latest(_view(spark, json_path, before=batch_id)).where("value IS NOT NULL").select(F.col("row_key").alias("key"), "value")
    if earlier:
        sizes = spark.read.schema(SIZES_SCHEMA).parquet(f"{folder}/batch={earlier[-1]}")
    else:  # none yet, or the documents are those of an earlier life in complete mode
        held = _document_cells(documents, job).groupBy("metric", "dim").agg(F.count(F.lit(1)).alias("keys")).collect()
        sizes = spark.createDataFrame([(*r, doubled(r["keys"], entries)) for r in held], SIZES_SCHEMA)
    docs, sizes = changed_documents(batch, documents, sizes, job, entries)
    as_cells(docs).write.mode("overwrite").parquet(f"{json_path}/delta={batch_id}")
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    if (batch_id + 1) % full_every == 0:
        _write_full(spark, store.latest(_view(spark, json_path, before=batch_id + 1)), json_path, batch_id)
    for b in earlier[:-1]:
        fs.delete(spark, f"{folder}/batch={b}")


def stored_documents(spark: SparkSession, json_store: str) -> DataFrame:
    """``key, value`` of the newest documents that the stream keeps in its ``json_store``."""
    return stored(spark, json_store).where("value IS NOT NULL").select(F.col("row_key").alias("key"), "value")


def stored(spark: SparkSession, store_path: str) -> DataFrame:
    """The newest value of each cell of the newest run in a store that the stream writes."""
    runs = [int(n[4:]) for n in fs.children(spark, store_path) if n.startswith("run=")]
    if not runs:
        return spark.createDataFrame([], store.CELL_SCHEMA)
    return store.latest(_view(spark, f"{store_path.rstrip('/')}/run={max(runs)}"))


def totals(spark: SparkSession, store_path: str) -> DataFrame:
    """``metric, dim, key, n`` — the latest running totals written by the streaming report."""
    return as_totals(stored(spark, store_path))


def state_totals(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``metric, dim, key, n`` — the running totals in the query's own state, read from its checkpoint (of
    the last batch that was committed, or of an earlier one whose state is still kept).

    The store isn't read, so this audits it and replaces it if it is lost. The query may be running.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", str(batch))
    state = reader.load(checkpoint)
    count = state.schema["value"].dataType.names[-1]  # the aggregate's one buffer
    return state.select("key.metric", "key.dim", "key.key", F.col("value")[count].cast("bigint").alias("n"))


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a query committed; -1 before its first."""
    return max([int(n) for n in fs.children(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()], default=-1)


def rebuild(spark: SparkSession, checkpoint: str, store_path: str) -> None:
    """Writes the store of a stopped query anew from its state: one full view, as of its last batch. The
    query can be started again on the same checkpoint and goes on from there."""
    batch = last_batch(spark, checkpoint)
    if batch >= 0:
        run = f"{store_path.rstrip('/')}/run={_run_of(spark, checkpoint, store_path)}"
        _write_full(spark, counts_as_cells(state_totals(spark, checkpoint, batch), F.lit(batch)), run, batch)


def differences(spark: SparkSession, checkpoint: str, store_path: str) -> DataFrame:
    """``metric, dim, key, in_state, in_store`` — the cells whose totals in the state and in the store differ."""
    cell = ["metric", "dim", "key"]
    state, kept = state_totals(spark, checkpoint).withColumnRenamed("n", "in_state"), totals(spark, store_path).withColumnRenamed("n", "in_store")
    return state.join(kept, cell, "full").where(~F.col("in_state").eqNullSafe(F.col("in_store"))).select(*cell, "in_state", "in_store")


def read_documents(documents: DataFrame) -> DataFrame:
    """``job, section, dim, key, n, broken`` — the totals in ``key, value`` documents, nested or doubly encoded.

    Chunks of a section come together again; ``dim`` is '' but for the dimensions. A document that
    can't be read gives one row with its text in ``broken`` and no total; an empty one gives none.
    """
    parsed = _parsed(documents)
    none = F.lit(None).cast("string")
    totals_ = _exploded(parsed.where("good")).select("job", "section", "dim", "key", "n", none.alias("broken"))
    return totals_.unionByName(parsed.where("not good").select("job", "section", none.alias("dim"), none.alias("key"), F.lit(None).cast("bigint").alias("n"), F.col("value").alias("broken")))


def _parsed(documents: DataFrame) -> DataFrame:
    """``job, section, value, inner, good``: ``inner`` maps parts to their counts where the document is ``good``."""
    maps = "map<string,map<string,bigint>>"
    job = F.substring_index("key", ":", 1)
    outer = F.from_json("value", "map<string,string>")  # an inner object comes as its text
    parsed = documents.select(job.alias("job"), F.regexp_replace(F.substr("key", F.char_length(job) + 2), r"#\d+$", "").alias("section"), "value", F.map_values(outer).alias("_v"))
    parsed = parsed.withColumn("inner", F.from_json(F.get("_v", F.lit(0)), maps, {"mode": "PERMISSIVE"}))
    good = F.col("inner").isNotNull() & (F.size("_v") == 1) & F.forall(F.map_values("inner"), lambda m: m.isNotNull() & F.forall(F.map_values(m), lambda n: n.isNotNull()))
    return parsed.withColumn("good", F.coalesce(good, F.lit(False)))


def _exploded(parsed: DataFrame) -> DataFrame:
    """``job, section, dim, key, n`` of parsed documents."""
    part = parsed.select("job", "section", F.explode("inner").alias("part", "counts"))
    dim = F.when(F.col("part") == F.col("section"), "").otherwise(F.col("part")).alias("dim")
    return part.select("job", "section", dim, F.explode("counts").alias("key", "n"))


def json_documents(report_totals: DataFrame, job: str, nested: bool = False, bare_key: bool = False, entries: int = CHUNK_ENTRIES) -> DataFrame:
    """``key, value`` — one document per metric under ``<job>:<section>``.

    ``value`` is ``{"<job>": "<inner JSON as a string>"}`` (doubly encoded, as the reference
    stores it); the inner document is ``{"<section>": {key: n}}`` for salaries and skills and
    ``{"<label>": {value: n}, ...}`` for the dimensions. A document holds a bounded number of keys:
    metrics with more have further documents ``<job>:<section>#1``, ... (see :func:`chunked`).

    ``nested=True`` embeds the inner document as an object instead of a string, and
    ``bare_key=True`` stores under ``<job>`` alone — the older copy's dimension-only output
    (use it with the ``other`` metric).
    """
    return _documents(chunked(report_totals, ["metric", "dim"], "key", entries, doubling=True), job, nested, bare_key)


def _documents(parts: DataFrame, job: str, nested: bool = False, bare_key: bool = False) -> DataFrame:
    """As :func:`json_documents`, of cells with their ``chunk``."""
    flat = parts.where(F.col("metric") != OTHER).groupBy("metric", "chunk").agg(sorted_map("key", "n").alias("m"))
    section = F.create_map(*[x for m, s in SECTIONS.items() if m != OTHER for x in (F.lit(m), F.lit(s))])
    flat_docs = flat.select("metric", "chunk", F.to_json(F.create_map(section[F.col("metric")], F.col("m"))).alias("inner"))

    per_dim = parts.where(F.col("metric") == OTHER).groupBy("metric", "dim", "chunk").agg(sorted_map("key", "n").alias("m"))
    other_docs = per_dim.groupBy("metric", "chunk").agg(F.to_json(nested_map("dim", "m")).alias("inner"))

    docs = flat_docs.unionByName(other_docs)
    key = chunk_name(F.lit(job)) if bare_key else _document_name(job, F.col("metric"), F.col("chunk"))
    if nested:
        quoted_job = F.regexp_replace(F.to_json(F.array(F.lit(job))), r"^\[|\]$", "")
        value = F.concat(F.lit("{"), quoted_job, F.lit(":"), F.col("inner"), F.lit("}"))
    else:
        value = envelope(job, F.col("inner"))
    return docs.select(key.alias("key"), value.alias("value"))
