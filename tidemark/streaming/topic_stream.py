"""Micro-batch topic processing with stored offsets (SRC-1..3, SNK-1, SNK-9,
PRJ-1..3, FLT-1, STR-1..5, OFF-1, OFF-4, OFF-9).

The query is a plain Structured Streaming query: ``readStream`` over the
topic, then ``foreachBatch`` which, per batch, (1) skips an empty batch,
(2) runs the caller's sinks (counters, record hooks), and (3) writes the
batch's offset ranges to the offset log and commits its position last
(``commit='after'``) or first (``commit='before'``). Sinks write per (run_id,
batch_id) with dynamic overwrite, so a batch replayed after a crash replaces
its own output.

The Spark checkpoint drives a running query; the committed position is what a
*new* checkpoint starts from (STR-3).
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from functools import reduce
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.keys import counter_key, day_of
from tidemark.operators.commits import CommitFile
from tidemark.operators.counters import CounterStore
from tidemark.operators.offsets import (OffsetLog, clamp_to_earliest, earliest_available, offset_ranges,
                                        resume_from_positions, start_positions)
from tidemark.session import delete_path, exists, scratch_dir
from tidemark.sources.common import wall_time
from tidemark.sources.topic import default_start, kafka_reader_options, kafka_records

BatchSink = Callable[[DataFrame, int], None]

LOSSES = ("run_id string, batch_id bigint, kind string, topic string, partition int, stored bigint, "
          "begins bigint, lost bigint")

#: Topic partitions whose ranges are observed with the counters' pass (three
#: expressions each); of more, the ranges are an aggregate of their own.
OBSERVED_PARTITIONS = 64

# Fixed value that must equal the original producer's: the value prefix.
PRODUCER_VALUE_PREFIX = "hlw:"


#: Records that a file of the file topic holds, about.
RECORDS_PER_FILE = 1_000_000


def write_file_topic(records: DataFrame, path: str, bursts: int = 1, offset_col: str = "offset",
                     files_per_burst: int | None = None, records_per_file: int = RECORDS_PER_FILE) -> int:
    """SNK-1: the producer side of the file topic. The records are appended in
    ``bursts``, each a commit of its own, in offset order: a later burst holds
    later offsets of every partition. A burst is as many files as its records
    need, written side by side as ranges of offsets; a reader that takes whole
    bursts (the returned number of files at a time) reads every partition in
    order. With ``files_per_burst`` each file is a commit of its own."""
    spark = records.sparkSession
    cols = schemas.TOPIC_RECORD.fieldNames()
    bounds = records.agg(F.min(offset_col), F.max(offset_col), F.count("*")).first()
    if bounds[1] is None:
        return 1
    commits = bursts * (files_per_burst or 1)
    files = 1 if files_per_burst else max(1, -(-bounds[2] // (bursts * records_per_file)))
    lo, step = bounds[0], (bounds[1] - bounds[0]) // commits + 1
    staging = scratch_dir(spark, "topic-staging")
    (records.select(*cols).repartitionByRange(commits * files, offset_col).sortWithinPartitions(offset_col, "partition")
     .write.parquet(staging))
    staged = spark.read.schema(records.select(*cols).schema).parquet(staging)
    for k in range(commits):
        burst = staged.filter((F.col(offset_col) >= lo + k * step) & (F.col(offset_col) < lo + (k + 1) * step))
        burst = (burst.coalesce(1) if files == 1 else
                 burst.repartitionByRange(files, offset_col).sortWithinPartitions(offset_col, "partition"))
        burst.write.mode("append").parquet(path)
    delete_path(spark, staging)
    return files


def produce_records(spark: SparkSession, source: DataFrame, ts_col: str = "ts") -> DataFrame:
    """SNK-1 record shape of the original producer: key = running number
    ``1..n``, value = ``"hlw:" + time``, one record per source row."""
    return source.select(
        (F.col("event_id") + 1).cast("string").alias("key"),
        F.concat(F.lit(PRODUCER_VALUE_PREFIX), wall_time(ts_col)).alias("value"))


def topic_stream(spark: SparkSession, path: str, topics: list[str] | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-1 on the file topic (the Kafka source needs a broker; see
    :func:`tidemark.sources.topic.kafka_reader_options`)."""
    r = spark.readStream.schema(schemas.TOPIC_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.parquet(path)
    if topics:
        df = df.filter(F.col("topic").isin(topics))
    return df


def day_category_key() -> F.Column:
    """FN-7 key of a topic record whose value is ``{"k": <category>}``."""
    return counter_key(day_of("timestamp"), F.get_json_object("value", "$.k").cast("int")).alias("rowkey")


def day_category_counts(batch: DataFrame) -> DataFrame:
    """AGG-3 on topic records."""
    return batch.groupBy(day_category_key()).agg(F.count(F.lit(1)).alias("click_count"))


def counter_sink(store: CounterStore, to_counts: Callable[[DataFrame], DataFrame] = day_category_counts,
                 compact_every: int | None = None) -> BatchSink:
    """SNK-3 as a batch sink: pre-aggregated deltas per batch. With
    ``compact_every`` the deltas are folded into a new base version every n
    batches, so reading the counters stays one base plus a few deltas."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        store.add(to_counts(batch), batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            store.compact()
    return sink


def partition_record_sink(process: Callable[[object], None] | None = None,
                          open: Callable[[int], object] | None = None,  # noqa: A002 - names of the hook
                          close: Callable[[object], None] | None = None) -> BatchSink:
    """SNK-9: per-partition record processing. ``open(partition)`` runs once
    per task and may return a resource, ``process(pandas_frame)`` - or
    ``process(resource, pandas_frame)`` with an ``open`` - gets the task's
    records in Arrow batches, ``close(resource)`` runs once at the end, also
    after an error. The sink returns the number of records the hooks saw (one
    small sum, not the records)."""
    def run(batch: DataFrame, batch_id: int) -> int:
        return int(partition_records(batch, process, open, close).agg(F.sum("records")).first()[0] or 0)
    return run


def partition_records(batch: DataFrame, process=None, open=None, close=None) -> DataFrame:  # noqa: A002
    """The hooks of :func:`partition_record_sink` over a frame: (task,
    records) for every task."""
    def per_part(it):
        import pandas as pd
        from pyspark import TaskContext
        task, n = TaskContext.get().partitionId(), 0
        resource = open(task) if open is not None else None
        try:
            for pdf in it:
                if process is not None:
                    process(resource, pdf) if open is not None else process(pdf)
                n += len(pdf)
        finally:
            if close is not None:
                close(resource)
        yield pd.DataFrame({"task": [task], "records": [n]})
    return batch.mapInPandas(per_part, "task int, records long")


def checkpoint_run(spark: SparkSession, store_root: str, checkpoint: str,
                   positions: Callable[[], list[tuple[str, int, int]]]) -> tuple[str, list[tuple[str, int, int]]]:
    """(run id, start positions) of a checkpoint, kept across its restarts. A
    checkpoint without Spark's ``metadata`` file is new - even at a reused
    path - and gets a new id (sortable: a nanosecond start stamp first), so
    its batch 0 can never overwrite an older run's output; what ``positions``
    returns then is stored with the id. Every start of the checkpoint applies
    those same positions: files it has not reached yet may hold older
    offsets."""
    tag = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    p = f"{store_root}/runs/ckpt={tag}"
    schema = "run_id string, starts array<struct<topic:string,partition:int,offset:bigint>>"
    if exists(spark, f"{checkpoint.rstrip('/')}/metadata") and exists(spark, p):
        row = spark.read.schema(schema).parquet(p).first()
        return row["run_id"], [tuple(x) for x in row["starts"] or []]
    rid, starts = f"{time.time_ns():020d}_{tag}", positions()
    spark.createDataFrame([(rid, starts)], schema).coalesce(1).write.mode("overwrite").parquet(p)
    return rid, starts


class TopicJob:
    """A resumable topic consumer.

    ``start()`` picks the start (STR-3): an existing checkpoint drives the
    query, cut to the positions it began from; for a new checkpoint with
    offsets stored for the group, the stream is cut to ``offset >= stored``
    per partition (Subscribe: other partitions from the beginning - new ones
    too, OFF-7; Assign: only stored partitions); with neither,
    ``auto_offset_reset`` decides (SRC-1): the beginning, or what arrives
    after this start.

    A topic partition's offsets must arrive in order. A batch that starts
    below the position an earlier one reached is refused.

    Positions are committed to one small file per group (``commits``), the
    last step of a batch; the offset log is the history of ranges. Counters
    are bound to that file, so counts and offsets commit in one step. A start
    whose position has expired begins at the earliest offset present (OFF-8),
    and what is gone is listed by ``lost``.

    With ``counters`` and ``commit='after'`` the ranges of partitions that the
    job knows are observed while the counters are written, so a batch is read
    once; only records of partitions it meets for the first time are looked at
    again."""

    def __init__(self, spark: SparkSession, topic_path: str, state_root: str, group_id: str,
                 topics: list[str], sinks: list[BatchSink], commit: str = "after",
                 mode: str = "subscribe", max_files_per_trigger: int | None = None,
                 checkpoint: str | None = None, kafka_bootstrap: str | None = None,
                 partition_counts: dict[str, int] | None = None,
                 counters: CounterStore | None = None,
                 counts: Callable[[DataFrame], DataFrame] = day_category_counts,
                 compact_every: int | None = None, auto_offset_reset: str = "earliest"):
        if commit not in ("after", "before"):
            raise ValueError("commit must be 'after' or 'before'")
        self.spark = spark
        self.topic_path = topic_path
        self.state_root = state_root.rstrip("/")
        self.group_id = group_id
        self.topics = topics
        self.sinks = sinks
        self.commit = commit
        self.mode = mode
        self.max_files = max_files_per_trigger
        self.checkpoint = checkpoint or f"{self.state_root}/checkpoint"
        self.kafka_bootstrap = kafka_bootstrap
        self.partition_counts = partition_counts
        self.log = OffsetLog(spark, f"{self.state_root}/offset_log")
        self.commits = CommitFile(spark, f"{self.state_root}/positions/{quote(group_id, safe='')}")
        self.default_start = default_start(auto_offset_reset)
        self.new_losses: list[tuple] = []
        self.run_id, self.starts = checkpoint_run(spark, self.state_root, self.checkpoint, self._first_positions)
        self._record_losses(-1)
        self.commits.take(self.run_id)
        self.counters, self.counts, self.compact_every = counters, counts, compact_every
        if counters is not None:
            counters.run_id = self.run_id  # counter deltas are keyed by this job's run
            if commit == "after":
                counters.bind(self.run_id, self.commits)
        self.batches_seen: list[int] = []
        self.last_ranges: list[tuple] = []
        self._positions: dict[tuple[str, int], int] | None = None
        self._newest_batch = -1

    def _first_positions(self) -> list[tuple[str, int, int]]:
        """Where a new checkpoint starts: the committed positions, not below
        what is still there; without any, and with ``latest``, the end of the
        file topic as it is now (the Kafka source knows its own end). One row
        per topic partition."""
        done = self.commits.read()
        if done is not None and done.ends:
            at = done.before("", 0, self.commit)
            stored = [(t, p, o) for (t, p), o in sorted(at.items()) if t in self.topics]
        else:  # a state folder from before there was a commit file
            stored = [(r.topic, r.partition, r.offset)
                      for r in self.log.latest(self.group_id, self.topics, self.commit).collect()]
        if self.kafka_bootstrap or not exists(self.spark, self.topic_path):
            return stored
        if stored:
            return self._clamped(stored)
        if self.default_start == "earliest":
            return stored
        return [(r.topic, r.partition, r.until_offset) for r in offset_ranges(
            self._present().filter(F.col("topic").isin(self.topics))).collect()]

    def _present(self) -> DataFrame:
        return self.spark.read.schema(schemas.TOPIC_RECORD).parquet(self.topic_path)

    def _clamped(self, stored: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """OFF-8 at the start: positions raised to the earliest offset that
        the topic still holds. Kafka's own source does this from the broker's
        knowledge; the file topic's is one pass over three narrow columns."""
        frame = self.spark.createDataFrame(stored, schemas.START_OFFSETS)
        raised = clamp_to_earliest(frame, earliest_available(self._present())).collect()
        found = {(r.topic, r.partition): r.offset for r in raised}
        self.new_losses += [("expired", t, p, o, found[t, p]) for t, p, o in stored if found[t, p] > o]
        return [(t, p, found[t, p]) for t, p, _ in stored]

    def _record_losses(self, batch_id: int) -> None:
        if self.new_losses:
            rows = [(self.run_id, batch_id, *x, x[4] - x[3]) for x in self.new_losses]
            self.spark.createDataFrame(rows, LOSSES).coalesce(1).write.mode("append").parquet(f"{self.state_root}/lost")
            self.new_losses = []

    def lost(self) -> DataFrame:
        """Offsets that this job's group never saw: ``expired`` before a start,
        or a ``gap`` between two batches (compacted topics have such)."""
        path = f"{self.state_root}/lost"
        return (self.spark.read.schema(LOSSES).parquet(path) if exists(self.spark, path)
                else self.spark.createDataFrame([], LOSSES))

    def _stored_positions(self, batch_id: int) -> dict[tuple[str, int], int]:
        """Last position per topic partition before this batch."""
        done = self.commits.read()
        if done is not None and done.ends:
            # partitions that this checkpoint began above their position, or without one
            began = {(t, p): o for t, p, o in self.starts}
            return {k: max(o, began.get(k, o)) for k, o in done.before(self.run_id, batch_id, self.commit).items()}
        log = self.log.read().filter(~((F.col("run_id") == self.run_id) & (F.col("batch_id") >= batch_id)))
        return {(r.topic, r.partition): r.offset
                for r in start_positions(log, self.group_id, self.commit, self.topics).collect()}

    def kafka_options(self) -> dict[str, str]:
        """Kafka source options for this job's start (STR-3): the stored
        positions - one row per topic partition, so collecting them is
        bounded - become ``startingOffsets``; Assign mode names only them."""
        start = self.starts or self._first_positions()  # the source itself ignores them once it has a checkpoint
        opts = kafka_reader_options(self.kafka_bootstrap, ",".join(self.topics), start=start or None,
                                    assign=self.mode == "assign", default_start=self.default_start,
                                    partition_counts=self.partition_counts)
        if self.max_files:
            opts["maxOffsetsPerTrigger"] = str(self.max_files)
        return opts

    def source(self) -> DataFrame:
        if self.kafka_bootstrap:
            raw = self.spark.readStream.format("kafka").options(**self.kafka_options()).load()
            return kafka_records(raw)
        df = topic_stream(self.spark, self.topic_path, self.topics, self.max_files)
        # one row per topic partition, applied on every start of this
        # checkpoint as a filter that reaches the file scan
        return resume_from_positions(df, self.starts, assign=self.mode == "assign") if self.starts else df

    def _known(self) -> list[tuple[str, int]]:
        """Topic partitions with a position, or named by ``partition_counts``."""
        named = {(t, p) for t in self.topics for p in range((self.partition_counts or {}).get(t, 0))}
        return sorted(named | set(self._positions))

    def _observed(self, batch: DataFrame, batch_id: int) -> list[tuple]:
        """Write the counters and return the batch's ranges, both from one
        pass. Records of partitions not known yet are looked at again."""
        known, watch = self._known(), Observation()
        mine = [(F.col("topic") == t) & (F.col("partition") == p) for t, p in known]
        seen = batch.observe(watch, F.count(F.lit(1)).alias("n"), *(
            f(F.when(c, F.col("offset"))).alias(f"{name}{i}") for i, c in enumerate(mine)
            for name, f in (("from", F.min), ("last", F.max), ("n", F.count))))
        self.counters.add(self.counts(seen), batch_id)
        try:
            got = watch.get
        except Py4JJavaError:  # Spark saw that there is nothing to read and observed nothing
            return [(r.topic, r.partition, r.from_offset, r.until_offset, r.record_count)
                    for r in offset_ranges(batch).collect()]
        rows = [(t, p, got[f"from{i}"], got[f"last{i}"] + 1, got[f"n{i}"])
                for i, (t, p) in enumerate(known) if got[f"n{i}"]]
        if got["n"] > sum(r[4] for r in rows):
            new = batch.filter(~reduce(Column.__or__, mine)) if mine else batch
            rows += [(r.topic, r.partition, r.from_offset, r.until_offset, r.record_count)
                     for r in offset_ranges(new).collect()]
        return rows

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        if self._positions is None or batch_id <= self._newest_batch:  # first batch, or a replay
            self._positions = self._stored_positions(batch_id)
        self._newest_batch = batch_id
        one_pass = self.counters is not None and self.commit == "after" and len(self._known()) <= OBSERVED_PARTITIONS
        again = bool(self.sinks) or not one_pass
        b = batch.persist() if again else batch  # read more than once
        try:
            if one_pass:
                got = self._observed(b, batch_id)
            else:  # OFF-1 / OFF-11: one row per topic partition of the batch
                got = [(r.topic, r.partition, r.from_offset, r.until_offset, r.record_count)
                       for r in offset_ranges(b).collect()]
            if not got:  # FLT-1: an empty batch
                return
            back = [(t, p, f) for t, p, f, *_ in got if f < self._positions.get((t, p), f)]
            if back:
                raise ValueError(f"offsets out of order: batch {batch_id} starts again at {back}, "
                                 f"positions are {self._positions}")
            self.new_losses += [("gap", t, p, self._positions[t, p], f) for t, p, f, *_ in got
                                if f > self._positions.get((t, p), f)]
            seen = {(t, p) for t, p, *_ in got}
            # partitions idle in this batch keep from = until = their position
            got += [(t, p, o, o, 0) for (t, p), o in sorted(self._positions.items()) if (t, p) not in seen]
            self.last_ranges = [g[:4] for g in got]
            ranges = self.spark.createDataFrame(
                got, "topic string, partition int, from_offset bigint, until_offset bigint, record_count bigint")
            if self.commit == "before":  # OFF-9: position saved before the work
                self._save(ranges, batch_id)
            if self.counters is not None and not one_pass:
                self.counters.add(self.counts(b), batch_id)
            for sink in self.sinks:
                sink(b, batch_id)
            if self.commit == "after":  # OFF-4: saved once the work is done
                self._save(ranges, batch_id)
            for t, p, _, u, _ in got:
                self._positions[t, p] = u
            self._record_losses(batch_id)
            self.batches_seen.append(batch_id)
            if self.compact_every and (batch_id + 1) % self.compact_every == 0:
                if self.counters is not None:
                    self.counters.compact()
                self.log.fold()
        finally:
            if again:
                b.unpersist()

    def _save(self, ranges: DataFrame, batch_id: int) -> None:
        """The history of ranges, then the position: the batch's commit."""
        self.log.append(ranges, self.group_id, self.run_id, batch_id)
        self.commits.commit(self.run_id, batch_id, self.last_ranges)

    def start(self, available_now: bool = False, interval: str = "5 seconds"):
        w = self.source().writeStream.foreachBatch(self.process_batch) \
            .option("checkpointLocation", self.checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
        return w.start()

    def run(self, interval: str = "5 seconds", marker: str | None = None, poll_s: float = 10.0) -> None:
        """STR-1 + STR-2: start with a fixed interval and wait; with a
        ``marker`` path, stop gracefully once it appears (STR-4)."""
        q = self.start(interval=interval)
        if marker:
            stop_on_marker(q, self.spark, marker, poll_s=poll_s)
        else:
            q.awaitTermination()

    def run_available(self) -> None:
        """Process everything present now and stop (STR-1 in tests)."""
        q = self.start(available_now=True)
        q.awaitTermination()


def stop_on_marker(query, spark: SparkSession, marker: str, poll_s: float = 10.0, grace_s: float = 2.0,
                   more_triggers: int = 1, max_wait_s: float | None = None) -> bool:
    """STR-4: poll every ``poll_s`` seconds; once ``marker`` exists, wait
    ``grace_s`` and stop between two triggers. A running trigger is waited
    for, however long it takes; a source that always has more data gets at
    most ``more_triggers`` further ones. Returns True when stopped by the
    marker. With ``max_wait_s`` the query is stopped (returning False) if no
    marker appeared in that time."""
    started = time.time()
    while query.isActive:
        if max_wait_s is not None and time.time() - started > max_wait_s:
            query.stop()
            return False
        if query.awaitTermination(poll_s):
            return False
        if exists(spark, marker):
            time.sleep(grace_s)
            done = lambda: (query.lastProgress or {}).get("batchId", -1)
            first = done()
            while query.isActive:
                st = query.status
                if not st["isTriggerActive"] and (not st["isDataAvailable"] or done() - first >= more_triggers):
                    break
                time.sleep(0.02)
            query.stop()
            return True
    return False
