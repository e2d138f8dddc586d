"""One commit over counters and offsets, the position file, stores under slow
writers, the foreach sink and the range report."""

import json
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.cells import CellTable, make_put
from tidemark.operators.commits import Commit, CommitFile, TakenOver, decode_positions, encode_positions
from tidemark.operators.counters import CounterStore
from tidemark.operators.offsets import OffsetLog
from tidemark.operators.snapshots import SnapshotStore
from tidemark.session import exists, list_files, local_path
from tidemark.sources.topic import topic_log
from tidemark.streaming.record_writer import EpochFiles, as_json, write_records
from tidemark.streaming.report import RangeReport
from tidemark.streaming.state_counters import StateCounters
from tidemark.streaming.topic_stream import TopicJob, day_category_key, topic_stream, write_file_topic


def _job(spark, root, checkpoint, store, **more):
    return TopicJob(spark, f"{root}/topic", f"{root}/state", "a group/1", ["events"], sinks=[], counters=store,
                    checkpoint=f"{root}/{checkpoint}", max_files_per_trigger=1, **more)


def _total(store):
    return store.read().agg(F.sum("click_count")).first()[0] or 0


def test_positions_text():
    at = {("a", 0): 5, ("a", 11): 0, ("b", 2): 9}
    assert encode_positions(at) == {"a": "0:5,11:0", "b": "2:9"}
    assert decode_positions(encode_positions(at)) == at and decode_positions({}) == {}
    c = Commit("r2", "r1", 4, {("a", 0): 1}, {("a", 0): 5}, {"r1": 4})
    assert Commit.of_text(c.to_text()) == c
    assert c.before("r1", 4, "after") == {("a", 0): 1} and c.before("r1", 5, "after") == {("a", 0): 5}
    assert c.before("new", 0, "after") == {("a", 0): 5} and c.before("new", 0, "before") == {("a", 0): 1}


def test_reader_never_sees_a_half_position(spark, tmp_root):
    one = CommitFile(spark, f"{tmp_root}/positions/g")
    one.take("r")
    seen, stop, errors = [], threading.Event(), []

    def read():
        try:
            while not stop.is_set():
                c = one.read()
                assert c is not None and set(c.ends.values()) in (set(), {c.batch_id})
                seen.append(c.batch_id)
        except BaseException as e:  # noqa: BLE001 - raised below
            errors.append(e)
    reader = threading.Thread(target=read)
    reader.start()
    for b in range(60):
        one.commit("r", b, [("t", p, b - 1, b) for p in range(200)])
    stop.set()
    reader.join()
    assert not errors and seen == sorted(seen) and len(set(seen)) > 3
    assert list_files(spark, f"{tmp_root}/positions") == ["g"]  # nothing is left aside


def test_crash_between_counters_and_commit(spark, tmp_root):
    write_file_topic(topic_log(spark, SF_SMALL), f"{tmp_root}/topic", bursts=4)
    store = CounterStore(spark, f"{tmp_root}/counters")
    job = _job(spark, tmp_root, "ck1", store)
    plain = job.commits.commit

    def fail(run, batch, ranges):
        if batch == 2:
            raise RuntimeError("crash")
        plain(run, batch, ranges)
    job.commits.commit = fail
    with pytest.raises(Exception, match="crash"):
        job.run_available()
    deltas = spark.read.parquet(store.deltas_path)
    assert deltas.select("batch_id").distinct().count() == 3  # the third is there and does not count
    assert _total(store) == 504
    store.compact()
    assert _total(CounterStore(spark, f"{tmp_root}/counters")) == 504
    later = _job(spark, tmp_root, "ck2", store)
    assert {o for _, _, o in later.starts} == {126}
    later.run_available()
    assert _total(store) == 1000
    # the first run is not dead after all: its late batch is refused
    with pytest.raises(TakenOver):
        plain(job.run_id, 2, [("events", 0, 0, 1)])
    assert _total(store) == 1000


def test_same_checkpoint_replays_over_the_lost_batch(spark, tmp_root):
    write_file_topic(topic_log(spark, SF_SMALL), f"{tmp_root}/topic", bursts=2)
    store = CounterStore(spark, f"{tmp_root}/counters")
    job = _job(spark, tmp_root, "ck", store)
    job.commits.commit = lambda *a: (_ for _ in ()).throw(RuntimeError("crash"))
    with pytest.raises(Exception, match="crash"):
        job.run_available()
    assert _total(store) == 0
    _job(spark, tmp_root, "ck", store).run_available()
    assert _total(store) == 1000


def test_start_below_the_earliest_offset(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    write_file_topic(topic.filter("offset < 50"), f"{tmp_root}/topic")
    store = CounterStore(spark, f"{tmp_root}/counters")
    job = _job(spark, tmp_root, "ck1", store)
    job.run_available()
    assert job.lost().count() == 0
    later = f"{tmp_root}/after"
    write_file_topic(topic.filter("offset >= 100 and not (partition = 1 and offset between 150 and 159)"),
                     f"{later}/topic", bursts=2)
    job = TopicJob(spark, f"{later}/topic", f"{tmp_root}/state", "a group/1", ["events"], sinks=[], counters=store,
                   checkpoint=f"{tmp_root}/ck2")
    assert {o for _, _, o in job.starts} == {100}
    job.run_available()
    lost = {(r.kind, r.partition): (r.stored, r.begins, r.lost) for r in job.lost().collect()}
    assert {k: v for k, v in lost.items() if k[0] == "expired"} == {("expired", p): (50, 100, 50) for p in range(4)}
    assert _total(store) == 1000 - 200 - 10


def test_ranges_come_from_the_counters_pass(spark, tmp_root, monkeypatch):
    topic = topic_log(spark, SF_SMALL).drop("batch_id")
    store = CounterStore(spark, f"{tmp_root}/counters")
    job = _job(spark, tmp_root, "ck", store, partition_counts={"events": 4})
    from tidemark.streaming import topic_stream as module
    monkeypatch.setattr(module, "offset_ranges", lambda *a: pytest.fail("a pass of its own"))
    job.process_batch(topic.filter("offset < 100"), 0)
    assert job.last_ranges == [("events", p, 0, 100) for p in range(4)]
    job.process_batch(topic.filter("offset >= 100 and partition <> 2"), 1)  # an idle partition
    assert job.last_ranges == [("events", p, 100, 250) for p in (0, 1, 3)] + [("events", 2, 100, 100)]
    monkeypatch.undo()
    new = topic.filter("partition = 0").withColumn("partition", F.lit(7))  # not known before
    job.process_batch(new, 2)
    assert ("events", 7, 0, 250) in job.last_ranges
    assert _total(store) == 1000 - 150 + 250


def test_slow_put_is_not_lost_by_a_compaction(spark, tmp_root):
    table = CellTable(spark, f"{tmp_root}/cells")
    slow = table._claim_op()
    table.put(make_put(spark, [("b", "f", "q", "1")], ts=1))
    assert table.current_op() == slow - 1 and table.compact() is None
    snaps = SnapshotStore(spark, f"{tmp_root}/snaps")
    snaps.take_table("early", table)
    late = CellTable(spark, table.path)
    late._claim_op = lambda: slow
    late.put(make_put(spark, [("a", "f", "q", "1")], ts=1))
    assert table.current_op() == 1 and snaps.read("early").count() == 0
    table.compact()
    assert sorted(r.rowkey for r in table.scan().collect()) == ["a", "b"]
    dead = table._claim_op()
    table.put(make_put(spark, [("c", "f", "q", "1")], ts=1))
    assert table.current_op() == 1
    table.abandon(dead)
    assert table.current_op() == 3 and table.compact() == 3


def test_fold_spares_what_lands_meanwhile(spark, tmp_root, monkeypatch):
    log = OffsetLog(spark, f"{tmp_root}/log")
    ranges = lambda a, b: spark.createDataFrame([("t", 0, a, b, b - a)], "topic string, partition int, from_offset bigint, "  # noqa: E731
                                                "until_offset bigint, record_count bigint")
    log.append(ranges(0, 10), "g", "r", 0)
    log.append(ranges(10, 20), "g", "r", 1)
    plain = log.read

    def read():
        before = plain()
        before.count()
        log.append(ranges(20, 30), "g", "r", 2)
        return before
    monkeypatch.setattr(log, "read", read)
    assert log.fold() == 1
    monkeypatch.undo()
    assert [r.offset for r in log.latest("g").collect()] == [30]


def test_two_compactions_take_two_versions(spark, tmp_root, monkeypatch):
    a = CounterStore(spark, tmp_root, "r")
    a.increment("k", 1, batch_id=0)
    b, made = CounterStore(spark, tmp_root, "r"), []
    summed = a._sum

    def slow(base, batches):
        if not made:
            a.increment("k", 10, batch_id=1)
            made.append(b.compact())
        return summed(base, batches)
    monkeypatch.setattr(a, "_sum", slow)
    assert a.compact() != made[0]
    assert dict(CounterStore(spark, tmp_root).read().collect()) == {"k": 11}


def _records(spark, root, process, **hooks):
    stream = topic_stream(spark, f"{root}/topic", ["events"], 1).select("topic", "partition", "offset")
    write_records(stream, EpochFiles(f"{root}/out", process, **hooks), f"{root}/ck", partitions=5).awaitTermination()


def test_foreach_handles_an_epoch_once(spark, tmp_root):
    write_file_topic(topic_log(spark, SF_SMALL), f"{tmp_root}/topic", bursts=2)
    said = f"{local_path(tmp_root)}-said"

    def note(line):
        with open(said, "a") as out:
            out.write(line + "\n")

    def fail(resource, row):
        if row["partition"] == 2 and row["offset"] == 200:
            raise RuntimeError("bad record")
        return as_json(row)

    def setup(partition, epoch):
        note(f"open {partition} {epoch}")
        return partition, epoch

    with pytest.raises(StreamingQueryException, match="bad record"):
        _records(spark, tmp_root, fail, setup=setup, teardown=lambda r, e: note(f"close {r[0]} {r[1]} {e}"))
    lines = open(said).read().splitlines()
    first = [x for x in lines if x.startswith("open") and x.endswith(" 0")]
    assert len(first) == len(set(first)) == 5
    assert any(x.startswith("close") and x.endswith("bad record") for x in lines)
    assert json.loads(spark.read.text(f"{tmp_root}/out/_failed").first()[0])["error"] == "RuntimeError: bad record"
    done = {f.name for f in __import__("pathlib").Path(f"{local_path(tmp_root)}/out/epoch=1").glob("part-*")}
    assert 0 < len(done) < 5
    again = []
    _records(spark, tmp_root, lambda r, row: as_json(row), setup=setup, teardown=lambda r, e: None)
    again = open(said).read().splitlines()[len(lines):]
    assert {x.split()[1] for x in again if x.startswith("open")}.isdisjoint({str(int(n[5:10])) for n in done})
    got = spark.read.schema("partition int, offset bigint").json(f"{tmp_root}/out").select("partition", "offset").collect()
    assert sorted(map(tuple, got)) == [(p, o) for p in range(4) for o in range(250)]


def test_report_has_a_row_per_trigger(spark, tmp_root):
    write_file_topic(topic_log(spark, SF_SMALL), f"{tmp_root}/topic", bursts=3)
    job = _job(spark, tmp_root, "ck", CounterStore(spark, f"{tmp_root}/counters"), partition_counts={"events": 4})
    report = RangeReport(spark, f"{tmp_root}/report", every=2)
    spark.streams.addListener(report)
    try:
        job.run_available()
        assert report.ended.wait(60)
    finally:
        spark.streams.removeListener(report)
    rows = sorted((r.batch_id, r.input_rows) for r in report.read().collect())
    log = dict(job.log.read().groupBy("batch_id").agg(F.sum("record_count")).collect())
    assert rows == sorted(log.items()) and len(rows) == 3
    assert report.read().filter("start_offset is null and batch_id > 0").count() == 0


def test_state_counters_after_a_restart(spark, tmp_root):
    topic = topic_log(spark, SF_SMALL)
    counters = StateCounters(spark, f"{tmp_root}/c")
    assert counters.read().count() == 0
    for part in ("offset < 100", "offset >= 100"):
        write_file_topic(topic.filter(part), f"{tmp_root}/topic")
        counters.start(topic_stream(spark, f"{tmp_root}/topic").select(day_category_key())).awaitTermination()
    want = dict(topic.select(F.col("*")).groupBy(day_category_key()).count().collect())
    assert dict(counters.read().collect()) == want
    assert exists(spark, f"{tmp_root}/c/totals/batch_id=1")


def test_many_files_a_burst(spark, tmp_root):
    files = write_file_topic(topic_log(spark, SF_SMALL), f"{tmp_root}/topic", bursts=2, records_per_file=100)
    assert files == 5
    names = [n for n in list_files(spark, f"{tmp_root}/topic") if n.endswith(".parquet")]
    assert len(names) == 10
    store = CounterStore(spark, f"{tmp_root}/counters")
    job = _job(spark, tmp_root, "ck", store)
    job.max_files = files
    job.run_available()
    assert job.batches_seen == [0, 1] and _total(store) == 1000
