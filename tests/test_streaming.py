import threading
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.counters import CounterStore
from tidemark.sources.topic import kafka_reader_options, starting_offsets_json, topic_log
from tidemark.streaming.topic_stream import (TopicJob, counter_sink, day_category_counts, partition_record_sink,
                                             stop_on_marker, write_file_topic)


def _expected(spark):
    return dict(day_category_counts(topic_log(spark, SF_SMALL)).collect())


def _job(spark, root, checkpoint=None, commit="after", sinks_extra=(), mode="subscribe"):
    store = CounterStore(spark, f"{root}/state/counters")
    job = TopicJob(spark, f"{root}/topic", f"{root}/state", "g", ["events"],
                   sinks=list(sinks_extra), commit=commit, mode=mode,
                   checkpoint=checkpoint, counters=store)
    return job, store


def test_stream_counts_resume_and_offsets(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    first = topic.filter(F.col("offset") < 100)
    rest = topic.filter(F.col("offset") >= 100)
    write_file_topic(first, f"{tmp_root}/topic", bursts=2)
    job, store = _job(spark, tmp_root)
    job.run_available()
    assert sum(r.click_count for r in store.read().collect()) == 400
    # more data arrives; the same checkpoint continues where it stopped
    write_file_topic(rest, f"{tmp_root}/topic", bursts=2)
    job2, store2 = _job(spark, tmp_root)
    assert job2.run_id == job.run_id
    job2.run_available()
    assert dict(store2.read().collect()) == _expected(spark)
    # offset log: per partition, ranges are contiguous and end at the topic end
    log = job2.log.read().orderBy("partition", "batch_id").collect()
    by_p = {}
    for r in log:
        by_p.setdefault(r.partition, []).append((r.from_offset, r.until_offset))
    for p, rs in by_p.items():
        assert rs[0][0] == 0
        assert all(a[1] == b[0] for a, b in zip(rs, rs[1:]))
        assert rs[-1][1] == 250
    assert sum(r.record_count for r in log) == 1000


def test_new_checkpoint_starts_from_offset_log(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic.filter(F.col("offset") < 120), f"{tmp_root}/topic", bursts=1)
    job, store = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck1")
    job.run_available()
    write_file_topic(topic.filter(F.col("offset") >= 120), f"{tmp_root}/topic", bursts=1)
    # a fresh checkpoint re-lists every file, but the stored offsets cut what was done
    job2, store2 = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck2")
    assert job2.run_id != job.run_id
    job2.run_available()
    assert dict(store2.read().collect()) == _expected(spark)


def test_commit_before_replays_last_batch(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic, f"{tmp_root}/topic", bursts=1)
    job, store = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck1", commit="before")
    job.run_available()
    seen = []
    job2, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck2", commit="before",
                   sinks_extra=[lambda b, i: seen.append(b.count())])
    job2.run_available()
    assert seen == [1000]  # the whole last batch is read again


def test_empty_batch_is_skipped(spark, tmp_root):
    job, store = _job(spark, tmp_root)
    empty = spark.createDataFrame([], "topic string, partition int, offset bigint, timestamp timestamp_ntz, "
                                      "key string, value string")
    job.process_batch(empty, 0)
    assert job.batches_seen == [] and job.log.read().count() == 0


def test_replayed_batch_is_idempotent(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL).drop("batch_id")
    job, store = _job(spark, tmp_root)
    job.process_batch(topic, 0)
    job.process_batch(topic, 0)
    assert dict(store.read().collect()) == _expected(spark)
    assert job.log.read().count() == 4


def test_partition_record_sink(spark):
    topic = topic_log(spark, SF_SMALL)
    assert partition_record_sink(lambda pdf: pdf["value"].str.len().sum())(topic, 0) == 1000
    assert partition_record_sink()(topic.filter("partition = 1"), 0) == 250


def test_marker_stop(spark, tmp_root):
    write_file_topic(topic_log(spark, SF_SMALL), f"{tmp_root}/topic", bursts=1)
    job, store = _job(spark, tmp_root)
    q = job.start(interval="1 second")
    marker = f"{tmp_root}/stop.marker"

    def drop():
        q.processAllAvailable()
        spark.range(1).write.parquet(marker)
    t = threading.Thread(target=drop)
    t.start()
    assert stop_on_marker(q, spark, marker, poll_s=0.5, grace_s=0.2)
    t.join()
    assert not q.isActive
    assert sum(r.click_count for r in store.read().collect()) == 1000


def _crash_from(calls):
    """A sink that fails from its n-th call on, before any later sink."""
    seen = []

    def sink(batch, batch_id):
        seen.append(batch_id)
        if len(seen) >= calls:
            raise RuntimeError("crash")
    return sink


def _run_to_crash(job):
    with pytest.raises(Exception, match="crash"):
        job.run_available()


def test_restart_of_a_checkpoint_begun_from_the_log(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic.filter("offset < 125"), f"{tmp_root}/topic", bursts=2)
    job, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck1")
    job.run_available()
    write_file_topic(topic.filter("offset >= 125"), f"{tmp_root}/topic", bursts=2)
    job2, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck2", sinks_extra=[_crash_from(2)])
    job2.max_files = 1
    try:
        job2.run_available()
    except Exception:  # noqa: BLE001 - the restart below is what counts
        pass
    job3, store = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck2")
    assert job3.run_id == job2.run_id and job3.starts == job2.starts
    job3.run_available()
    assert dict(store.read().collect()) == _expected(spark)


def test_commit_before_loses_nothing(spark, tmp_root):
    """A crash before the work, then a first batch that holds one partition
    only: the idle partitions keep their own start."""
    topic = topic_log(spark, SF_SMALL)
    for p in range(4):
        write_file_topic(topic.filter(F.col("partition") == p), f"{tmp_root}/topic")
    job, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck1", commit="before")
    job.sinks.insert(0, _crash_from(1))
    _run_to_crash(job)
    seen = []
    job2, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck2", commit="before",
                   sinks_extra=[lambda b, i: seen.extend(map(tuple, b.select("partition", "offset").collect()))])
    job2.max_files = 1
    job2.sinks.append(_crash_from(1))
    _run_to_crash(job2)
    job3, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck3", commit="before",
                   sinks_extra=[lambda b, i: seen.extend(map(tuple, b.select("partition", "offset").collect()))])
    job3.run_available()
    assert set(seen) == {(p, o) for p in range(4) for o in range(250)}


def test_many_files_a_burst_resume(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL).repartition(4, "key")
    write_file_topic(topic, f"{tmp_root}/topic", files_per_burst=4)
    assert spark.read.parquet(f"{tmp_root}/topic").select(F.input_file_name()).distinct().count() == 4
    job, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck1")
    job.max_files = 1
    job.sinks.append(_crash_from(2))
    _run_to_crash(job)
    job2, store = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck2")
    job2.run_available()
    # the second batch was counted under the first run too, but not committed
    assert sum(r.click_count for r in store.read().collect()) == 1000
    assert job2.log.read().agg(F.sum("record_count")).first()[0] == 1000


def test_offsets_out_of_order_are_refused(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL).drop("batch_id")
    job, _ = _job(spark, tmp_root)
    job.process_batch(topic.filter("offset >= 100"), 0)
    with pytest.raises(ValueError, match="out of order"):
        job.process_batch(topic.filter("offset < 150"), 1)


def test_latest_start_reads_what_arrives_later(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic.filter("offset < 200"), f"{tmp_root}/topic")
    store = CounterStore(spark, f"{tmp_root}/state/counters")

    def job():
        return TopicJob(spark, f"{tmp_root}/topic", f"{tmp_root}/state", "g", ["events"], sinks=[], counters=store,
                        auto_offset_reset="largest")
    job().run_available()
    assert store.read().count() == 0
    write_file_topic(topic.filter("offset >= 200"), f"{tmp_root}/topic")
    job().run_available()
    assert sum(r.click_count for r in store.read().collect()) == 200


def test_marker_waits_for_a_running_batch(spark, tmp_root):
    write_file_topic(topic_log(spark, SF_SMALL), f"{tmp_root}/topic")
    done = []

    def slow(batch, batch_id):
        spark.range(1).write.parquet(f"{tmp_root}/stop.marker")
        time.sleep(4)
        done.append(batch_id)
    job, _ = _job(spark, tmp_root, sinks_extra=[slow])
    q = job.start(interval="1 second")
    assert stop_on_marker(q, spark, f"{tmp_root}/stop.marker", poll_s=0.2, grace_s=0)
    assert done == [0] and job.log.read().count() == 4


def test_partition_hooks(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL).repartition(3)

    def process(resource, pdf):
        resource["n"] += len(pdf)

    def close(resource):
        assert resource["n"] > 0
    sink = partition_record_sink(process, open=lambda task: {"task": task, "n": 0}, close=close)
    assert sink(topic, 0) == 1000


def test_offset_log_fold(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic, f"{tmp_root}/topic", bursts=5)
    job, _ = _job(spark, tmp_root)
    job.max_files = 1
    job.run_available()
    before = sorted(map(tuple, job.log.latest("g").collect()))
    job.log.fold()
    assert sorted(map(tuple, job.log.latest("g").collect())) == before and job.log.read().count() == 4


def test_kafka_options():
    o = kafka_reader_options("b:9092", "events,other")
    assert o["subscribe"] == "events,other" and o["startingOffsets"] == "earliest"
    o = kafka_reader_options("b:9092", "events", start=[("events", 1, 15), ("events", 0, 12)])
    assert o["startingOffsets"] == starting_offsets_json([("events", 0, 12), ("events", 1, 15)])
    assert o["startingOffsets"] == '{"events": {"0": 12, "1": 15}}'
    o = kafka_reader_options("b:9092", "events", start=[("events", 1, 15)], assign=True)
    assert o["assign"] == '{"events": [1]}' and "subscribe" not in o


def test_kafka_options_fill_partitions_and_job(spark, tmp_root):
    js = starting_offsets_json([("events", 0, 12)], partition_counts={"events": 3})
    assert js == '{"events": {"0": 12, "1": -2, "2": -2}}'
    job, _ = _job(spark, tmp_root)
    job.kafka_bootstrap = "broker:9092"
    assert job.kafka_options()["startingOffsets"] == "earliest"  # nothing stored yet
    ranges = spark.createDataFrame([("events", 0, 0, 10, 10), ("events", 1, 0, 7, 7)],
                                   "topic string, partition int, from_offset bigint, until_offset bigint, "
                                   "record_count bigint")
    job.log.append(ranges, "g", job.run_id, 0)
    job.partition_counts = {"events": 4}
    o = job.kafka_options()
    assert o["subscribe"] == "events"
    assert o["startingOffsets"] == '{"events": {"0": 10, "1": 7, "2": -2, "3": -2}}'
    job.mode = "assign"
    o = job.kafka_options()
    assert o["assign"] == '{"events": [0, 1]}' and o["startingOffsets"] == '{"events": {"0": 10, "1": 7}}'


def test_reused_checkpoint_path_gets_new_run(spark, tmp_root, monkeypatch):
    import tidemark.streaming.topic_stream as ts
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic.filter(F.col("offset") < 100), f"{tmp_root}/topic", bursts=1)
    job, store = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck")
    job.run_available()
    job_again, _ = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck")
    assert job_again.run_id == job.run_id  # same live checkpoint: same run
    # a checkpoint path whose Spark metadata is gone counts as a new run
    real_exists = ts.exists
    monkeypatch.setattr(ts, "exists", lambda s, p: False if p.endswith("/metadata") else real_exists(s, p))
    job2, store2 = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck")
    monkeypatch.setattr(ts, "exists", real_exists)
    assert job2.run_id != job.run_id and job2.run_id > job.run_id
    write_file_topic(topic.filter(F.col("offset") >= 100), f"{tmp_root}/topic", bursts=1)
    job2.run_available()
    assert dict(store2.read().collect()) == _expected(spark)


def test_idle_partition_logged_with_empty_range(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL).drop("batch_id")
    job, store = _job(spark, tmp_root)
    job.process_batch(topic.filter("offset < 10"), 0)
    job.process_batch(topic.filter("offset >= 10 AND offset < 20 AND partition != 2"), 1)
    b1 = {r.partition: (r.from_offset, r.until_offset, r.record_count)
          for r in job.log.read().filter("batch_id = 1").collect()}
    assert b1 == {0: (10, 20, 10), 1: (10, 20, 10), 2: (10, 10, 0), 3: (10, 20, 10)}


def test_stream_with_compaction(spark, tmp_root):
    from tidemark.session import list_dirs
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic, f"{tmp_root}/topic", bursts=4)
    store = CounterStore(spark, f"{tmp_root}/state/counters")
    job = TopicJob(spark, f"{tmp_root}/topic", f"{tmp_root}/state", "g", ["events"],
                   sinks=[counter_sink(store, compact_every=2)], max_files_per_trigger=1)
    store.run_id = job.run_id
    job.run_available()
    assert len(job.batches_seen) >= 2
    assert list_dirs(spark, f"{tmp_root}/state/counters/base")
    assert dict(store.read().collect()) == _expected(spark)


def test_kafka_records_mapping(spark):
    import datetime

    from tidemark.sources.topic import kafka_records
    raw = spark.createDataFrame(
        [(bytearray(b"7"), bytearray(b'{"k": 3}'), "events", 2, 41, datetime.datetime(2024, 1, 5, 10, 0, 0), 0)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
        "timestampType int")
    r = kafka_records(raw).first()
    assert (r.topic, r.partition, r.offset, r.key, r.value) == ("events", 2, 41, "7", '{"k": 3}')
    assert kafka_records(raw).schema["timestamp"].dataType.typeName() == "timestamp_ntz"
    assert dict(day_category_counts(kafka_records(raw)).collect()) == {"20240105_3": 1}


def test_new_partition_read_from_start_on_resume(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    # the topic had partitions 0..2; partition 3 appears while the consumer is stopped
    write_file_topic(topic.filter("partition < 3 AND offset < 150"), f"{tmp_root}/topic", bursts=1)
    job, store = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck1")
    job.run_available()
    assert {r.partition for r in job.log.read().collect()} == {0, 1, 2}
    write_file_topic(topic.filter("partition = 3 OR offset >= 150"), f"{tmp_root}/topic", bursts=2)
    job2, store2 = _job(spark, tmp_root, checkpoint=f"{tmp_root}/ck2")
    job2.run_available()
    assert dict(store2.read().collect()) == _expected(spark)
    last = {r.partition: r.offset for r in job2.log.latest("g").collect()}
    assert last == {0: 250, 1: 250, 2: 250, 3: 250}


def test_marker_query_has_no_time_limit(spark, monkeypatch):
    import itertools
    import types
    from tidemark.plans import registry
    from tidemark.streaming import topic_stream
    clock = itertools.count(0, 1000)  # a thousand seconds between any two looks
    monkeypatch.setattr(topic_stream, "time", types.SimpleNamespace(
        time=lambda: next(clock), sleep=time.sleep, time_ns=time.time_ns))
    assert registry.q_stream_marker_stop(spark, SF_SMALL).first()[0] == 1000
    monkeypatch.setattr(registry.S, "stop_on_marker", lambda *a, **k: stop_on_marker(*a, **k) and False)
    with pytest.raises(RuntimeError, match="before the marker"):
        registry.q_stream_marker_stop(spark, SF_SMALL)
