"""Streaming report: batch = stream, restart on the same checkpoint, resume with new files."""

import json

from pyspark.sql import functions as F

from postlens import fs
from postlens.functions.parse import postings
from postlens.operators.skills import dictionary_needs
from postlens.session import scratch_path
from postlens.sources.fixture import posting_lines
from postlens.sources.text import keyword_dictionary, stream_lines, write_lines
from postlens.streaming import report as sr
from tests.conftest import SF_SMALL


def batch_totals(spark, lines_df):
    d = keyword_dictionary(spark)
    rows = sr.stream_rows(postings(lines_df, "line"), d, dictionary_needs(d))
    return sorted(map(tuple, sr.running_counts(rows).collect()))


def run(spark, src, store_path, ckpt):
    lines = stream_lines(spark, "files", {"maxFilesPerTrigger": "1"}, path=src)
    q = sr.start(spark, lines, keyword_dictionary(spark), store_path, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_stream_equals_batch_restart_and_resume(spark):
    all_lines = posting_lines(spark, SF_SMALL)
    first = all_lines.where(F.col("id") < 4000)
    second = all_lines.where(F.col("id") >= 4000)
    src = scratch_path(spark, "test-stream-in")
    write_lines(first.repartition(3), src + "/part1")
    store_path, ckpt = scratch_path(spark, "test-stream-store"), scratch_path(spark, "test-stream-ckpt")

    q = run(spark, src + "/*", store_path, ckpt)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = sorted(map(tuple, sr.totals(spark, store_path).collect()))
    assert got == batch_totals(spark, first)

    # Restart on the same checkpoint with no new input: no batch with data.
    q2 = run(spark, src + "/*", store_path, ckpt)
    assert all(p["numInputRows"] == 0 for p in q2.recentProgress)
    assert sorted(map(tuple, sr.totals(spark, store_path).collect())) == got

    # New files: the totals continue from the checkpointed state.
    write_lines(second.repartition(2), src + "/part2")
    run(spark, src + "/*", store_path, ckpt)
    assert sorted(map(tuple, sr.totals(spark, store_path).collect())) == batch_totals(spark, all_lines)


def test_json_documents_are_doubly_encoded(spark):
    tot = spark.createDataFrame(
        [("salary_floor", "", "3000-6000", 2), ("skills", "", "java", 1), ("other", "地址", "北京", 3),
         ("other", "学历", "本科", 4), ("salary_ceiling", "", "6000-9000", 5)],
        "metric string, dim string, key string, n long",
    )
    docs = {r["key"]: r["value"] for r in sr.json_documents(tot, "javaweb").collect()}
    assert set(docs) == {"javaweb:可能实际情况下的工资", "javaweb:理想状态下的工资", "javaweb:职位要求分析", "javaweb:其他"}
    outer = json.loads(docs["javaweb:其他"])
    assert json.loads(outer["javaweb"]) == {"地址": {"北京": 3}, "学历": {"本科": 4}}
    outer = json.loads(docs["javaweb:可能实际情况下的工资"])
    assert json.loads(outer["javaweb"]) == {"可能实际情况下的工资": {"3000-6000": 2}}


def test_stream_source_options(spark):
    import pytest

    from postlens.sources.text import kafka_options

    opts = kafka_options("h1:9092,h2:9092", "first,second", startingOffsets="earliest")
    assert opts == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "first,second",
                    "startingOffsets": "earliest"}
    with pytest.raises(ValueError):
        stream_lines(spark, "socket", {})
    with pytest.raises(ValueError):
        stream_lines(spark, "files", {})  # a file stream needs a path


def test_nested_documents_under_bare_key(spark):
    tot = spark.createDataFrame([("other", "地址", "北京", 3)], "metric string, dim string, key string, n long")
    rows = sr.json_documents(tot, 'a"b', nested=True, bare_key=True).collect()
    assert [r["key"] for r in rows] == ['a"b']
    assert json.loads(rows[0]["value"]) == {'a"b': {"地址": {"北京": 3}}}


def test_complete_mode_equals_update_mode(spark):
    lines = posting_lines(spark, SF_SMALL)
    src = scratch_path(spark, "test-stream-modes")
    write_lines(lines.repartition(3), src)
    out = {}
    for mode in ("update", "complete"):
        store_path = scratch_path(spark, f"test-stream-{mode}")
        stream = stream_lines(spark, "files", {"maxFilesPerTrigger": "1"}, path=src)
        q = sr.start(spark, stream, keyword_dictionary(spark), store_path, scratch_path(spark, "ck"),
                     trigger={"availableNow": True}, output_mode=mode, metrics=[sr.SALARY_CEILING, sr.OTHER])
        q.awaitTermination()
        out[mode] = sorted(map(tuple, sr.totals(spark, store_path).collect()))
    assert out["update"] == out["complete"] and len(out["update"]) > 0


def test_state_partitions_option_restores_session_setting(spark):
    src = write_lines(posting_lines(spark, SF_SMALL), scratch_path(spark, "test-stream-parts"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream = stream_lines(spark, "files", {}, path=src)
    q = sr.start(spark, stream, keyword_dictionary(spark), scratch_path(spark, "st"), scratch_path(spark, "ck"),
                 trigger={"availableNow": True}, metrics=[sr.OTHER], state_partitions=3)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3


def test_interrupted_stream_resumes_exactly_once(spark):
    import time

    lines = posting_lines(spark, SF_SMALL)
    src = write_lines(lines.repartition(4), scratch_path(spark, "test-stream-int"))
    store_path, ckpt = scratch_path(spark, "test-stream-int-store"), scratch_path(spark, "test-stream-int-ckpt")
    stream = stream_lines(spark, "files", {"maxFilesPerTrigger": "1"}, path=src)
    q = sr.start(spark, stream, keyword_dictionary(spark), store_path, ckpt, trigger={"processingTime": "1 second"})
    deadline = time.time() + 120
    while time.time() < deadline and not [p for p in q.recentProgress if p["numInputRows"] > 0]:
        time.sleep(0.5)
    q.stop()  # interrupted after at least one batch, possibly mid-batch
    run(spark, src, store_path, ckpt)  # resume and drain
    assert sorted(map(tuple, sr.totals(spark, store_path).collect())) == batch_totals(spark, lines)


def test_per_batch_json_store(spark):
    src = write_lines(posting_lines(spark, SF_SMALL).repartition(4), scratch_path(spark, "test-stream-json"))
    store_path, json_path = scratch_path(spark, "tsj-store"), scratch_path(spark, "tsj-json")
    stream = stream_lines(spark, "files", {"maxFilesPerTrigger": "1"}, path=src)
    q = sr.start(spark, stream, keyword_dictionary(spark), store_path, scratch_path(spark, "tsj-ck"),
                 trigger={"availableNow": True}, json_store=json_path, job="javaweb")
    q.awaitTermination()
    # Whole views only, of the last two batches: earlier ones are gone, nothing was read back.
    assert fs.children(spark, json_path + "/run=0") == ["full=2", "full=3"]
    latest = {r["row_key"]: r["value"] for r in sr.stored(spark, json_path).collect()}
    want = {r["key"]: r["value"] for r in sr.json_documents(sr.totals(spark, store_path), "javaweb").collect()}
    assert latest == want and len(want) == 4


def test_fresh_checkpoint_on_an_old_store_gives_the_new_totals(spark):
    lines = posting_lines(spark, SF_SMALL)
    old = write_lines(lines.repartition(4), scratch_path(spark, "test-stream-old"))
    few = lines.where("id < 40")
    new = write_lines(few, scratch_path(spark, "test-stream-new"))
    store_path = scratch_path(spark, "test-stream-lives")
    run(spark, old, store_path, scratch_path(spark, "ck-old"))
    run(spark, new, store_path, scratch_path(spark, "ck-new"))
    assert sorted(map(tuple, sr.totals(spark, store_path).collect())) == batch_totals(spark, few)
    assert fs.children(spark, store_path) == ["run=0", "run=1"]


def test_sink_keeps_few_folders(spark):
    lines = posting_lines(spark, SF_SMALL)
    src = write_lines(lines.repartition(9), scratch_path(spark, "test-stream-full"))
    store_path = scratch_path(spark, "test-stream-full-store")
    stream = stream_lines(spark, "files", {"maxFilesPerTrigger": "1"}, path=src)
    q = sr.start(spark, stream, keyword_dictionary(spark), store_path, scratch_path(spark, "ck-full"),
                 trigger={"availableNow": True}, full_every=3)
    q.awaitTermination()
    assert q.exception() is None
    assert fs.children(spark, store_path + "/run=0") == ["delta=6", "delta=7", "full=5", "full=8"]
    assert sorted(map(tuple, sr.totals(spark, store_path).collect())) == batch_totals(spark, lines)


def test_replay_of_a_full_view_batch(spark):
    lines = posting_lines(spark, SF_SMALL)
    src = write_lines(lines.repartition(4), scratch_path(spark, "test-stream-replay"))
    store_path, ckpt = scratch_path(spark, "test-stream-replay-store"), scratch_path(spark, "ck-replay")
    for life in range(3):
        stream = stream_lines(spark, "files", {"maxFilesPerTrigger": "1"}, path=src)
        q = sr.start(spark, stream, keyword_dictionary(spark), store_path, ckpt, trigger={"availableNow": True}, full_every=2)
        q.awaitTermination()
        assert q.exception() is None
        assert fs.children(spark, store_path + "/run=0") == ["delta=2", "full=1", "full=3"]
        assert sorted(map(tuple, sr.totals(spark, store_path).collect())) == batch_totals(spark, lines)
        for name in ("3", ".3.crc"):  # as if the driver had died before batch 3 was committed
            if fs.exists(spark, f"{ckpt}/commits/{name}"):
                fs.delete(spark, f"{ckpt}/commits/{name}")


def test_stopped_streams_leave_nothing_cached(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    src = write_lines(posting_lines(spark, SF_SMALL), scratch_path(spark, "test-stream-cache"))
    run(spark, src, scratch_path(spark, "cache-store"), scratch_path(spark, "cache-ck"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_echo_prints_batches_and_keeps_totals(spark):
    lines = posting_lines(spark, SF_SMALL)
    src = write_lines(lines.repartition(2), scratch_path(spark, "test-stream-echo"))
    store_path = scratch_path(spark, "tse-store")
    stream = stream_lines(spark, "files", {"maxFilesPerTrigger": "1"}, path=src)
    q = sr.start(spark, stream, keyword_dictionary(spark), store_path, scratch_path(spark, "tse-ck"),
                 trigger={"availableNow": True}, echo=True)
    q.awaitTermination()
    assert q.exception() is None
    assert sorted(map(tuple, sr.totals(spark, store_path).collect())) == batch_totals(spark, lines)
