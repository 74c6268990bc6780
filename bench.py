"""Benchmark the headline queries; prints ONE JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (default 3; the median is reported).

Untimed setup: the posting lines Spark derives from ``orders ⋈ customer ⋈ nation`` are written
once as text files, so the report queries read raw posting text as a production job would. The
store, lookup and stream queries are timed as they are registered, with all that they write. Each
timed run executes the whole plan into the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postlens import schema  # noqa: E402
from postlens.functions.parse import gate  # noqa: E402
from postlens.operators import dimensions, salary, skills  # noqa: E402
from postlens.plans import registry, report  # noqa: E402
from postlens.session import local_session, scratch_path  # noqa: E402
from postlens.sources.fixture import posting_lines, table  # noqa: E402
from postlens.sources.text import keyword_dictionary, read_postings, write_lines  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_exchanges(df) -> int:
    """Data shuffles (hash, range, single) in the physical plan; a reused one counts once."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum(text.count(k) for k in (
        "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
    )) - text.count("ReusedExchange")


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return statistics.median(samples)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 2), app="postlens-bench")
    spark.sparkContext.setLogLevel("ERROR")

    text_dir = write_lines(posting_lines(spark, sf_dir).repartition(max(cpus, 3)), scratch_path(spark, "bench-postings"))
    dictionary = keyword_dictionary(spark)
    needs = skills.dictionary_needs(dictionary)

    def posts():
        return read_postings(spark, text_dir)

    def documents():
        return table(spark, sf_dir, "documents", ["text"])

    # Batch queries: builders returning the DataFrame; each run executes it into the noop sink.
    batch = {
        "full_report": lambda: report.full_report(posts(), dictionary, needs=needs),
        "dimension_counts": lambda: dimensions.counts(gate(posts(), min_fields=schema.GATE_DIMENSIONS)),
        "salary_histograms": lambda: salary.two_sided_histogram(gate(posts(), exact=schema.GATE_FULL)),
        "skill_keyword_count": lambda: skills.keyword_counts(
            gate(posts(), exact=schema.GATE_FULL), dictionary, needs=needs
        ),
        "document_word_count": lambda: skills.ranked_word_counts(
            skills.word_counts(documents(), "text", schema.STOP_WORDS)
        ),
        "cell_store_latest": lambda: registry.q_cell_store_latest(spark, sf_dir),
        "common_owner_lookup": lambda: registry.q_common_owner_lookup(spark, sf_dir),
    }

    def q_stream_report():
        run_noop(registry.q_stream_report(spark, sf_dir))

    plan = {name: (lambda build=build: run_noop(build())) for name, build in batch.items()}
    plan["stream_report"] = q_stream_report
    # Shuffle exchanges in each batch query's physical plan (broadcasts not counted). Queries that
    # cut lineage with a checkpoint (ranks) or a written store count the plan after the cut.
    exchanges = {name: shuffle_exchanges(build()) for name, build in batch.items()}
    results = {}
    for name, fn in plan.items():
        results[name] = round(timed(fn, runs), 3)
        print(name, results[name], file=sys.stderr, flush=True)
    n_postings = spark.read.text(text_dir).count()
    n_docs = table(spark, sf_dir, "documents", ["doc_id"]).count()
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "shuffle_exchanges": exchanges,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "postings": n_postings,
        "documents": n_docs,
        "stream_postings_per_sec": round(n_postings / results["stream_report"], 1),
        "full_report_postings_per_sec": round(n_postings / results["full_report"], 1),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
