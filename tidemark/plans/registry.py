"""
DuckDB oracle. Each query reads the driver tables through the views in
:mod:`tidemark.plans.views` and runs over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.codecs import bytes_to_long, from_utf8, long_to_bytes, long_to_hex
from tidemark.functions.keys import SPLIT_KEYS, random_code, region_of, salted_key
from tidemark.functions.offsets import decode_offsets, encode_offsets
from tidemark.operators import cells as CL
from tidemark.operators import counters as C
from tidemark.operators import offsets as O
from tidemark.operators import paging as P
from tidemark.operators.snapshots import SnapshotStore
from tidemark.plans import views as V
from tidemark.plans.views import with_views
from tidemark.session import delete_path, scratch_dir
from tidemark.sources.common import key_list_frame
from tidemark.sources.tables import read_table
from tidemark.sources.topic import select_topics
from tidemark.streaming import topic_stream as S
from tidemark.streaming.record_writer import EpochFiles, as_json, write_records
from tidemark.streaming.report import RangeReport
from tidemark.streaming.state_counters import StateCounters

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the resume scenarios: a consumer that stopped half way through
# the topic's batches, a group that stored only partitions 0 and 1, a topic
# that had 3 partitions, and retention that dropped a third of the batches and
# one more for each higher partition.
STORED_PARTITIONS = (0, 1)
OLD_PARTITION_COUNT = 3
INCREMENTS = [("20240101_1", 5), ("20991231_0", 2), ("20240101_1", 7)]
COUNTER_KEYS = ["20240101_1", "20240115_42", "20991231_0"]
CELL_KEYS = ["u5", "nope", "u1", "u5"]
DELETE_KEYS = ["u5", "u1", "nope"]
PUT_TS = 9_000_000_000_000  # later than every event


# ---- counters --------------------------------------------------------------

def q_click_count_by_category(spark, sf):
    return V.counters(spark, sf)


def q_click_count_by_search(spark, sf):
    return V.search_counters(spark, sf)


def q_counter_increment_merge(spark, sf):
    """Per-batch increments (what each micro-batch adds, SNK-3) merged into
    counters (AGG-1): the sum over batches equals the one-shot count."""
    per_batch = V.topic(spark, sf).groupBy("batch_id", S.day_category_key()).agg(
        F.count(F.lit(1)).alias("click_count"))
    return C.merge_increments(per_batch)


def q_counter_store_replay(spark, sf):
    """SNK-3 on the stored counter table: every batch's deltas are written to
    its own partition, a batch is then replayed, and the read-back equals the
    one-shot count (no double counting)."""
    store = C.CounterStore(spark, scratch_dir(spark, "counters"), run_id=V.RUN_ID)
    per_record = V.topic(spark, sf).select("batch_id", S.day_category_key(), F.lit(1).alias("click_count"))
    store.add_many(per_record)
    store.add(per_record.filter(F.col("batch_id") == 0), batch_id=0)
    return store.read()


def q_counter_late_batch(spark, sf):
    """Batches are written and compacted, then one of a lower id arrives and
    one is replayed; the counters are compacted again."""
    store = C.CounterStore(spark, scratch_dir(spark, "counters"), run_id=V.RUN_ID)
    late = _last_batch(spark, sf) // 2
    per_record = V.topic(spark, sf).select("batch_id", S.day_category_key(), F.lit(1).alias("click_count"))
    store.add_many(per_record.filter(F.col("batch_id") != late))
    store.compact()
    store.add(per_record.filter(F.col("batch_id") == late), batch_id=late)
    store.add(per_record.filter(F.col("batch_id") == 0), batch_id=0)
    store.compact()
    return store.read()


def q_counter_increment_one(spark, sf):
    """SNK-4: one-key increments on top of the counters, each call adds."""
    store = C.CounterStore(spark, scratch_dir(spark, "counters"))
    store.add(V.counters(spark, sf), batch_id=0)
    for key, amount in INCREMENTS:
        store.increment(key, amount)
    store.compact()
    return store.read()


def _stored_counters(spark, sf):
    """The counters as a stored table: a compacted, key-sorted base."""
    store = C.CounterStore(spark, scratch_dir(spark, "counters"))
    store.add(V.counters(spark, sf), batch_id=0)
    store.compact()
    return store


def q_counter_get(spark, sf):
    return _stored_counters(spark, sf).get(COUNTER_KEYS)


# ---- batches and offsets ---------------------------------------------------

def q_batch_record_count(spark, sf):
    t = V.topic(spark, sf)
    return t.groupBy("batch_id").agg(F.count(F.lit(1)).alias("record_count")).filter(F.col("record_count") > 0)


def q_empty_batch_skip(spark, sf):
    """FLT-1: the job is handed the topic's batches with an empty one before
    and after; only batches with records reach the sinks and the log."""
    root = scratch_dir(spark, "skip")
    topic = V.topic(spark, sf)
    job = S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"],
                     sinks=[lambda b, i: b.select("topic", "partition", "offset").withColumn("handed", F.lit(i))
                            .write.parquet(f"{root}/seen/{i}")])
    half = _last_batch(spark, sf) // 2
    for i, batch in enumerate((topic.limit(0), topic.filter(F.col("batch_id") <= half), topic.limit(0),
                               topic.filter(F.col("batch_id") > half), topic.limit(0))):
        job.process_batch(batch.drop("batch_id"), i)
    seen = [spark.read.parquet(f"{root}/seen/{i}") for i in job.batches_seen]
    logged = job.log.read().groupBy("batch_id").agg(F.sum("record_count").alias("logged"))
    handed = seen[0]
    for df in seen[1:]:
        handed = handed.unionByName(df)
    return (handed.groupBy(F.col("handed").cast("bigint").alias("batch_id")).agg(F.count("*").alias("records"))
            .join(logged, "batch_id", "full").select("batch_id", "records", "logged"))


def q_record_sink(spark, sf):
    """SNK-9 over a bounded topic: the hooks of each task (open, process,
    close) over the records dealt out by topic partition."""
    topic = V.topic(spark, sf)

    def process(resource, pdf):
        resource["records"] += len(pdf)
        resource["bytes"] += int(pdf["value"].str.len().sum())

    counted = S.partition_records(topic.repartition("partition"), process,
                                  open=lambda task: {"records": 0, "bytes": 0}, close=dict.clear)
    return counted.agg(F.sum("records").alias("records"))


def q_stream_foreach_records(spark, sf):
    """SNK-9 on a running query: records go through ``foreach`` to one file
    per partition and epoch. The first run fails in an epoch after some of its
    partitions were published; the restart replays it and handles the rest.
    Each record comes out once."""
    root = scratch_dir(spark, "foreach")
    files = S.write_file_topic(V.topic(spark, sf), f"{root}/topic", bursts=2)
    place = f"{root}/records"

    def fail(row):
        if row["partition"] == V.DEFAULT_PARTITIONS - 1 and row["offset"] >= V.DEFAULT_BATCH_RECORDS // 2:
            raise RuntimeError("crash of the scenario")
        return as_json(row)

    def run(process):
        stream = S.topic_stream(spark, f"{root}/topic", ["events"], files).select("topic", "partition", "offset")
        write_records(stream, EpochFiles(place, process), f"{root}/checkpoint").awaitTermination()
    try:
        run(fail)
    except StreamingQueryException as e:
        if "crash of the scenario" not in str(e):
            raise
    run(as_json)
    seen = spark.read.schema("topic string, partition int, offset bigint").json(place)
    return seen.groupBy("topic", "partition").agg(
        F.count("*").alias("records"), F.countDistinct("offset").alias("offsets"), F.min("offset").alias("first"),
        F.max("offset").alias("last"))


def q_offset_ranges(spark, sf):
    """With the partitions that were idle in the last batch: of that batch
    only the records of partition 0 are taken."""
    topic = V.topic(spark, sf)
    last = _last_batch(spark, sf)
    before = topic.filter(F.col("batch_id") < last)
    previous = before.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
    now = topic.filter((F.col("batch_id") == last) & (F.col("partition") == 0))
    ranges = O.offset_ranges(now, previous=previous).withColumn("batch_id", F.lit(last).cast("bigint"))
    return O.offset_ranges(before, by=["batch_id"]).unionByName(ranges)


def q_offset_range_report(spark, sf):
    return O.range_report(O.offset_ranges(V.topic(spark, sf), by=["batch_id"])).select("batch_id", "line")


def q_offset_encode(spark, sf):
    return encode_offsets(O.offset_ranges(V.topic(spark, sf), by=["batch_id"]), ["batch_id"])


def q_offset_decode(spark, sf):
    enc = encode_offsets(O.offset_ranges(V.topic(spark, sf), by=["batch_id"]), ["batch_id"])
    return decode_offsets(enc, keep=["batch_id"])


def _last_batch(spark, sf) -> int:
    return V.topic(spark, sf).agg(F.max("batch_id")).first()[0] or 0


def _stored_at_stop(spark, sf):
    log = V.offset_log(spark, sf).filter(F.col("batch_id") <= _last_batch(spark, sf) // 2)
    return O.latest_offsets(log, V.GROUP_ID)


def q_offset_latest(spark, sf):
    """Latest stored position per partition after the whole topic was read."""
    return O.latest_offsets(V.offset_log(spark, sf), V.GROUP_ID)


def q_offset_found(spark, sf):
    return O.found_flags(V.offset_log(spark, sf), [V.GROUP_ID, "nobody"], "events")


def q_offset_add_partitions(spark, sf):
    t = V.topic(spark, sf)
    old = V.offset_log(spark, sf).filter(F.col("partition") < OLD_PARTITION_COUNT)
    stored = O.latest_offsets(old, V.GROUP_ID).select("topic", "partition", "offset")
    current = t.select("topic", "partition").distinct()
    return O.add_new_partitions(stored, current)


def q_offset_clamp(spark, sf):
    t = V.topic(spark, sf)
    retained = t.filter(F.col("batch_id") >= F.col("partition") + _last_batch(spark, sf) // 3)
    return O.clamp_to_earliest(_stored_at_stop(spark, sf), O.earliest_available(retained))


def _records(df):
    return df.select("topic", "partition", "offset", "key", "value")


def q_offset_paths(spark, sf):
    return O.offset_paths(O.latest_offsets(V.offset_log(spark, sf), V.GROUP_ID))


def q_offset_commit_before(spark, sf):
    start = O.start_positions(V.offset_log(spark, sf), V.GROUP_ID, commit="before")
    return _records(O.resume_subscribe(V.topic(spark, sf), start))


def q_resume_subscribe(spark, sf):
    stored = _stored_at_stop(spark, sf).filter(F.col("partition").isin(list(STORED_PARTITIONS)))
    return _records(O.resume_subscribe(V.topic(spark, sf), stored))


def q_resume_pushdown(spark, sf):
    """Same resume as ``resume_subscribe``, with the stored positions (one
    per topic partition) applied as a filter that reaches the scan."""
    stored = _stored_at_stop(spark, sf).filter(F.col("partition").isin(list(STORED_PARTITIONS)))
    positions = [(r.topic, r.partition, r.offset) for r in stored.collect()]
    return _records(O.resume_from_positions(V.topic(spark, sf), positions))


def q_resume_assign(spark, sf):
    stored = _stored_at_stop(spark, sf).filter(F.col("partition").isin(list(STORED_PARTITIONS)))
    return _records(O.resume_assign(V.topic(spark, sf), stored))


def q_topic_values(spark, sf):
    return select_topics(V.topic(spark, sf), "events").select("topic", "partition", "offset", "value")


def q_topic_generate(spark, sf):
    """SNK-1: the generated records go through the topic writer and are read
    back from its files."""
    made = S.produce_records(spark, read_table(spark, sf, "events"))
    number = F.col("key").cast("bigint") - 1
    records = made.select(
        F.lit("generated").alias("topic"), F.pmod(number, F.lit(V.DEFAULT_PARTITIONS)).cast("int").alias("partition"),
        F.expr(f"(CAST(key AS BIGINT) - 1) div {V.DEFAULT_PARTITIONS}").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"), "key", "value")
    path = f"{scratch_dir(spark, 'generated')}/topic"
    records.write.parquet(path)  # a generated topic needs no order between its files
    return spark.read.schema(schemas.TOPIC_RECORD).parquet(path).select("key", "value")


# ---- cells -----------------------------------------------------------------

def q_cell_put_latest(spark, sf):
    """Last write wins by (ts, seq): the later half of the writes carries
    times out of order, every third of them older than all earlier ones."""
    cells = V.cells(spark, sf)
    n = read_table(spark, sf, "events").select(F.max("event_id")).scalar()
    base = cells.filter(F.col("seq") * 2 <= n)
    puts = cells.filter(F.col("seq") * 2 > n)
    puts = puts.withColumn("ts", F.when(F.col("seq") % 3 == 0, F.lit(n) - F.col("seq")).otherwise(F.col("ts")))
    return V.readable(CL.latest_cells(CL.put_cells(base, puts)))


def q_cell_put_one(spark, sf):
    """SNK-5 on a stored table: the last record's cell of each event type is
    put again, one cell at a time, with a later time."""
    cells = V.cells(spark, sf)
    t = CL.CellTable(spark, scratch_dir(spark, "cells"))
    t.put(cells)
    newest = cells.groupBy("qualifier").agg(F.max_by("rowkey", "seq").alias("rowkey"), F.max("seq").alias("seq"))
    for r in newest.collect():  # one row per event type
        t.put_one(r["rowkey"], "info", r["qualifier"], f"again {r['seq']}", ts=PUT_TS)
    return t.scan().select("rowkey", "cf", "qualifier", "ts", from_utf8("value").alias("value_text"))


def q_cell_versions_compacted(spark, sf):
    """All versions of a table written in two halves, after compaction."""
    cells = V.cells(spark, sf)
    n = read_table(spark, sf, "events").select(F.max("event_id")).scalar()
    t = CL.CellTable(spark, scratch_dir(spark, "cells"))
    t.put(cells.filter(F.col("seq") * 2 <= n))
    t.put(cells.filter(F.col("seq") * 2 > n))
    t.compact()
    return V.readable(t.versions(CL.MAX_VERSIONS))


def q_cell_delete(spark, sf):
    return V.readable(CL.delete_rows(V.cells(spark, sf), DELETE_KEYS))


def _stored_cells(spark, sf) -> CL.CellTable:
    """The cells as a stored, key-sorted table: lookups prune its scan."""
    t = CL.CellTable(spark, scratch_dir(spark, "cells"))
    t.put(V.cells(spark, sf))
    return t


def q_get_row(spark, sf):
    return V.readable(_stored_cells(spark, sf).get("u5"))


def q_get_rows(spark, sf):
    return V.readable(_stored_cells(spark, sf).get_many(CELL_KEYS), "pos")


def q_first_row(spark, sf):
    return CL.first_row(V.counters(spark, sf), F.col("click_count") >= 5)


def q_first_cell_row(spark, sf):
    """The first row (key order) with a non-error cell, with those cells."""
    return V.readable(_stored_cells(spark, sf).first(F.col("qualifier") != "error"))


def q_range_scan(spark, sf):
    return CL.range_scan(_stored_counters(spark, sf).read(), "20240105", "20240106")


def q_filter_scan(spark, sf):
    return CL.filter_scan(V.counters(spark, sf), F.col("click_count") >= 5, F.col("rowkey").endswith("7"))


def q_cell_versions(spark, sf):
    return CL.cell_versions(V.cells(spark, sf), 3).select("rowkey", "cf", "qualifier", "ts", "seq", "version")


def q_scan_page(spark, sf):
    """The paged scan in one call: key range, predicate, newest 2 versions,
    then the first page of 10 rows."""
    page = _stored_cells(spark, sf).page(10, start="u1", stop="u5", predicates=(F.col("qualifier") != "error",),
                                         max_versions=2)
    return V.readable(page, "version")


def q_cell_page_rows(spark, sf):
    """Second page of 10 rows (all their visible cells) after row u105."""
    return V.readable(_stored_cells(spark, sf).page(10, after="u105"))


def q_bucketed_cells(spark, sf):
    """The cell table stored bucketed by row key: two put operations (each
    half of the events), one delete operation, then the visible table."""
    cells = V.cells(spark, sf)
    n = read_table(spark, sf, "events").select(F.max("event_id")).scalar()
    t = CL.BucketedCellTable(spark, scratch_dir(spark, "cells"), buckets=8)
    t.put(cells.filter(F.col("seq") * 2 <= n))
    t.put(cells.filter(F.col("seq") * 2 > n))
    t.delete(DELETE_KEYS)
    return V.readable(t.scan())


def q_cell_table_compacted(spark, sf):
    """Folder-layout cell table: two puts, a compaction into a base, then a
    delete after it; the visible table is read from base + newer ops."""
    cells = V.cells(spark, sf)
    n = read_table(spark, sf, "events").select(F.max("event_id")).scalar()
    t = CL.CellTable(spark, scratch_dir(spark, "cells"))
    t.put(cells.filter(F.col("seq") * 2 <= n))
    t.put(cells.filter(F.col("seq") * 2 > n))
    t.compact(keep_versions=1)
    t.delete(DELETE_KEYS)
    return V.readable(t.scan())


def q_table_scan(spark, sf):
    return V.readable(CL.latest_cells(V.cells(spark, sf)))


def q_cell_format(spark, sf):
    return CL.format_cells(CL.latest_cells(V.cells(spark, sf)))


# ---- paging ----------------------------------------------------------------

def q_page_first(spark, sf):
    return P.page_first(V.counters(spark, sf), V.PAGE_SIZE)


def q_page_next(spark, sf):
    c = V.counters(spark, sf)
    last = P.page_first(c, V.PAGE_SIZE).agg(F.max("rowkey")).scalar()
    return P.page_next(c, last, V.PAGE_SIZE)


def q_page_all(spark, sf):
    return P.paginate(V.counters(spark, sf), V.PAGE_SIZE)


def q_page_summary(spark, sf):
    return P.page_summary(P.paginate(V.counters(spark, sf), V.PAGE_SIZE), V.PAGE_SIZE)


# ---- functions -------------------------------------------------------------

def _signed(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id")
    return ev.select("event_id", ((F.lit(500) - F.col("event_id")) * F.lit(1000003)).alias("n"))


def q_long_to_bytes_hex(spark, sf):
    return _signed(spark, sf).select("event_id", "n", long_to_hex("n").alias("hex"))


def _presplit_cells(spark, sf) -> CL.CellTable:
    """Cells under salted row keys in a table pre-split at the 15 split keys:
    two puts with a compaction between them."""
    cells = V.cells(spark, sf).withColumn("rowkey", salted_key("rowkey"))
    n = read_table(spark, sf, "events").select(F.max("event_id")).scalar()
    t = CL.CellTable(spark, scratch_dir(spark, "cells"), split_keys=SPLIT_KEYS)
    t.put(cells.filter(F.col("seq") * 2 <= n))
    t.compact()
    t.put(cells.filter(F.col("seq") * 2 > n))
    return t


def _salted(spark, keys: list[str]) -> list[str]:
    return [r[0] for r in key_list_frame(spark, keys).select(salted_key("rowkey")).collect()]  # a key list


def q_region_get_row(spark, sf):
    """One row of a pre-split table, from its region's folders."""
    return V.readable(_presplit_cells(spark, sf).get(*_salted(spark, ["u5"])))


def q_region_get_rows(spark, sf):
    """Scattered rows of a pre-split table, a missing and a repeated one too."""
    return V.readable(_presplit_cells(spark, sf).get_many(_salted(spark, CELL_KEYS)), "pos")


def q_region_range(spark, sf):
    """A key range over several regions."""
    return V.readable(_presplit_cells(spark, sf).range("4_u3", "B"))


def q_bytes_to_long(spark, sf):
    return _signed(spark, sf).select("event_id", "n", bytes_to_long(long_to_bytes("n")).alias("decoded"))


def q_salted_key(spark, sf):
    return V.counters(spark, sf).select("rowkey", salted_key("rowkey").alias("salted"))


def q_region_skew(spark, sf):
    s = V.counters(spark, sf).select(salted_key("rowkey").alias("salted"))
    return s.groupBy(region_of("salted").alias("region")).agg(F.count(F.lit(1)).alias("keys"))


def q_random_code(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id")
    return ev.select("event_id", random_code(8, "ALL_CHAR", seed=7).alias("code"))


def q_random_code_check(spark, sf):
    """FN-4, what holds for every random code: one per row, of the asked
    length, from the alphabet, not all alike."""
    code = q_random_code(spark, sf)
    return code.agg(F.count("code").alias("codes"), F.min(F.length("code")).alias("shortest"),
                    F.max(F.length("code")).alias("longest"),
                    F.sum(F.length(F.regexp_replace("code", "[0-9A-Za-z]", ""))).alias("other_characters"),
                    (F.countDistinct("code") > 1).alias("vary"))


# ---- snapshots -------------------------------------------------------------

def q_snapshot_roundtrip(spark, sf):
    store = SnapshotStore(spark, scratch_dir(spark, "snapshots"))
    store.take("cells_latest", CL.latest_cells(V.cells(spark, sf)))
    return V.readable(store.read("cells_latest"))


def q_snapshot_table(spark, sf):
    """A zero-copy snapshot of a cell table taken after the first put (the
    first half of the events); later puts and deletes do not change it."""
    cells = V.cells(spark, sf)
    n = read_table(spark, sf, "events").select(F.max("event_id")).scalar()
    root = scratch_dir(spark, "snaptable")
    t = CL.CellTable(spark, f"{root}/cells")
    store = SnapshotStore(spark, f"{root}/snapshots")
    t.put(cells.filter(F.col("seq") * 2 <= n))
    store.take_table("first_half", t)
    t.put(cells.filter(F.col("seq") * 2 > n))
    t.delete(DELETE_KEYS)
    return V.readable(store.read("first_half"))


def q_snapshot_collect(spark, sf):
    """Two snapshots of a cell table and one copy; after a compaction the first
    snapshot and the copy are dropped and what only they needed is removed. The
    second snapshot and the table are read afterwards."""
    cells = V.cells(spark, sf)
    n = read_table(spark, sf, "events").select(F.max("event_id")).scalar()
    root = scratch_dir(spark, "snapcollect")
    t = CL.CellTable(spark, f"{root}/cells")
    store = SnapshotStore(spark, f"{root}/snapshots")
    t.put(cells.filter(F.col("seq") * 2 <= n))
    store.take_table("first_half", t)
    t.compact()
    t.put(cells.filter(F.col("seq") * 2 > n))
    store.take_table("all", t)
    store.take("copy", t.scan())
    t.delete(DELETE_KEYS)
    t.compact()
    store.drop("first_half")
    store.drop("copy")
    gone = store.collect_garbage(grace_s=0)
    kept = store.read("all").withColumn("name", F.lit("all")).unionByName(t.scan().withColumn("name", F.lit("table")))
    return V.readable(kept, "name", F.lit(len(gone)).alias("folders_removed"))


def _three_snapshots(spark, sf):
    store = SnapshotStore(spark, scratch_dir(spark, "snapshots"))
    store.take("daily_a", V.counters(spark, sf))
    store.take("daily_b", V.search_counters(spark, sf))
    store.take("weekly_a", CL.latest_cells(V.cells(spark, sf)))
    return store


def _with_rows(store, live):
    names = [r["snapshot_name"] for r in live.collect()]  # one row per snapshot
    frames = [store.read(n).select(F.lit(n).alias("snapshot_name")) for n in names]
    if not frames:
        return store.spark.createDataFrame([], "snapshot_name string, rows bigint")
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("snapshot_name").agg(F.count(F.lit(1)).alias("rows"))


def q_snapshot_list(spark, sf):
    store = _three_snapshots(spark, sf)
    return _with_rows(store, store.list("daily_.*"))


def q_snapshot_drop(spark, sf):
    store = _three_snapshots(spark, sf)
    store.drop_matching("daily_.*")
    store.drop("nope")
    return _with_rows(store, store.list(""))


# ---- streaming -------------------------------------------------------------

def _stream_job(spark, sf, bursts=4):
    root = scratch_dir(spark, "stream")
    # each producer burst becomes a micro-batch of its own
    files = S.write_file_topic(V.topic(spark, sf), f"{root}/topic", bursts=bursts)
    store = C.CounterStore(spark, f"{root}/state/counters")
    job = S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"], sinks=[], counters=store,
                     max_files_per_trigger=files, partition_counts={"events": V.DEFAULT_PARTITIONS})
    return job, store, root


def q_stream_counters(spark, sf):
    """Stream the topic in micro-batches (SRC-1, STR-1): counter deltas per
    batch, then the offset log; the counters read back equal the one-shot
    count."""
    job, store, _ = _stream_job(spark, sf)
    job.run_available()
    return store.read()


def q_stream_resume(spark, sf):
    """STR-3: a consumer reads the first part of the topic and stops; more
    records arrive; a consumer with a *new* checkpoint starts from the
    offset log. The counters over both runs equal the one-shot count."""
    root = scratch_dir(spark, "stream")
    topic = V.topic(spark, sf)
    hi = topic.agg(F.max("offset")).first()[0]
    cut = (hi + 1) // 2
    S.write_file_topic(topic.filter(F.col("offset") < cut), f"{root}/topic", bursts=2)
    store = C.CounterStore(spark, f"{root}/state/counters")

    def job(ckpt):
        return S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"], sinks=[],
                          counters=store, checkpoint=f"{root}/{ckpt}")
    job("ck1").run_available()
    S.write_file_topic(topic.filter(F.col("offset") >= cut), f"{root}/topic", bursts=2)
    job("ck2").run_available()
    return store.read()


class _Crash:
    """A sink that fails from its n-th call on: what a crash leaves behind."""

    def __init__(self, calls: int):
        self.calls = calls

    def __call__(self, batch, batch_id):
        self.calls -= 1
        if self.calls <= 0:
            raise RuntimeError("crash of the scenario")


def _run_to_crash(job):
    try:
        job.run_available()
    except Exception as e:  # noqa: BLE001 - only the scenario's own crash is expected
        if "crash of the scenario" not in str(e):
            raise


def q_stream_restart_from_log(spark, sf):
    """A new checkpoint begins from the offset log, does one trigger, stops
    and is started again: nothing is counted twice."""
    root = scratch_dir(spark, "stream")
    topic = V.topic(spark, sf)
    cut = ((topic.agg(F.max("offset")).first()[0] or 0) + 1) // 2
    store = C.CounterStore(spark, f"{root}/state/counters")

    def job(ckpt, files=None):
        return S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"], sinks=[], counters=store,
                          checkpoint=f"{root}/{ckpt}", max_files_per_trigger=files)
    S.write_file_topic(topic.filter(F.col("offset") < cut), f"{root}/topic", bursts=2)
    job("ck1").run_available()
    files = S.write_file_topic(topic.filter(F.col("offset") >= cut), f"{root}/topic", bursts=2)
    stopped = job("ck2", files=3 * files)
    stopped.sinks.insert(0, _Crash(2))
    _run_to_crash(stopped)
    job("ck2").run_available()
    return store.read()


def q_stream_commit_before_replay(spark, sf):
    """Positions saved before the work: a crash before any work, then a
    checkpoint whose first batch holds one partition only and that crashes
    after it. Every record is seen at least once in the end."""
    root = scratch_dir(spark, "stream")
    topic = V.topic(spark, sf)
    for p in range(V.DEFAULT_PARTITIONS):
        files = S.write_file_topic(topic.filter(F.col("partition") == p), f"{root}/topic")

    def job(ckpt, files=None):
        return S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"], commit="before",
                          sinks=[lambda b, i: b.select("topic", "partition", "offset").write.mode("append")
                                 .parquet(f"{root}/seen")],
                          checkpoint=f"{root}/{ckpt}", max_files_per_trigger=files)
    first = job("ck1")
    first.sinks.insert(0, _Crash(1))
    _run_to_crash(first)
    second = job("ck2", files=files)
    second.sinks.insert(0, _Crash(2))
    _run_to_crash(second)
    job("ck3").run_available()
    return spark.read.parquet(f"{root}/seen").distinct()


def q_stream_resume_multi_file(spark, sf):
    """A burst of four files, written from records dealt out by key, read a
    file at a time; the consumer stops after the first batch and a new
    checkpoint goes on from the log."""
    root = scratch_dir(spark, "stream")
    S.write_file_topic(V.topic(spark, sf).repartition(4, "key"), f"{root}/topic", files_per_burst=4)
    store = C.CounterStore(spark, f"{root}/state/counters")

    def job(ckpt):
        return S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"], sinks=[], counters=store,
                          checkpoint=f"{root}/{ckpt}", max_files_per_trigger=1)
    stopped = job("ck1")
    stopped.sinks.insert(0, _Crash(2))
    _run_to_crash(stopped)
    job("ck2").run_available()
    return store.read()


class _CrashAtCommit:
    """A commit file whose n-th commit fails: counters and the log's rows are
    written then, the commit is not."""

    def __init__(self, commits, calls: int):
        self.commits, self.calls = commits, calls

    def __getattr__(self, name):
        return getattr(self.commits, name)

    def commit(self, *args):
        self.calls -= 1
        if self.calls <= 0:
            raise RuntimeError("crash of the scenario")
        self.commits.commit(*args)


def q_stream_crash_between_writes(spark, sf):
    """STR-5 / SNK-3: a consumer dies after a batch's counters and before its
    commit; a new checkpoint goes on from the committed position. Every click
    counts once."""
    job, store, root = _stream_job(spark, sf)
    job.commits = _CrashAtCommit(job.commits, 3)
    _run_to_crash(job)
    S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"], sinks=[], counters=store,
               checkpoint=f"{root}/ck2", max_files_per_trigger=job.max_files).run_available()
    return store.read()


def q_stream_clamped_start(spark, sf):
    """OFF-8 in the live start: a consumer stops after the first quarter of
    the offsets, the second quarter expires, a new checkpoint starts at the
    earliest offset present and reports what is lost."""
    root = scratch_dir(spark, "stream")
    topic = V.topic(spark, sf)
    top = (topic.agg(F.max("offset")).first()[0] or 0) + 1
    store = C.CounterStore(spark, f"{root}/state/counters")

    def job(ckpt):
        return S.TopicJob(spark, f"{root}/topic", f"{root}/state", V.GROUP_ID, ["events"], sinks=[], counters=store,
                          checkpoint=f"{root}/{ckpt}")
    S.write_file_topic(topic.filter(F.col("offset") < top // 4), f"{root}/topic")
    job("ck1").run_available()
    delete_path(spark, f"{root}/topic")
    S.write_file_topic(topic.filter(F.col("offset") >= top // 2), f"{root}/topic", bursts=2)
    last = job("ck2")
    last.run_available()
    read = last.log.read().groupBy("topic", "partition").agg(F.sum("record_count").cast("bigint").alias("records"))
    return (last.lost().select("kind", "topic", "partition", "stored", "begins", "lost")
            .join(read, ["topic", "partition"], "full"))


def q_stream_range_report(spark, sf):
    """OFF-11 of a running query: a listener's row per trigger, next to what
    the offset log says of that batch."""
    job, _, root = _stream_job(spark, sf)
    report = RangeReport(spark, f"{root}/report")
    spark.streams.addListener(report)
    try:
        job.run_available()
        if not report.ended.wait(600):
            raise RuntimeError("the end of the query was not reported")
    finally:
        spark.streams.removeListener(report)
    logged = job.log.read().groupBy("batch_id").agg(F.sum("record_count").cast("bigint").alias("logged_rows"),
                                                    F.count("*").alias("partitions"))
    return report.read().select("batch_id", "input_rows").join(logged, "batch_id", "full")


def q_stream_counters_state(spark, sf):
    """AGG-3 as a streaming aggregation in update mode, stopped after some
    triggers and started again: equal to the one-shot count."""
    root = scratch_dir(spark, "stream")
    topic = V.topic(spark, sf)
    cut = ((topic.agg(F.max("offset")).first()[0] or 0) + 1) // 2
    counters = StateCounters(spark, f"{root}/counters")
    for part in (F.col("offset") < cut, F.col("offset") >= cut):
        files = S.write_file_topic(topic.filter(part), f"{root}/topic", bursts=2)
        keys = S.topic_stream(spark, f"{root}/topic", ["events"], files).select(S.day_category_key())
        counters.start(keys).awaitTermination()
    return counters.read()


def q_stream_marker_stop(spark, sf):
    job, store, root = _stream_job(spark, sf)
    q = job.start(interval="500 milliseconds")
    marker = f"{root}/stop.marker"
    import threading

    failed = []

    def drop_marker():
        try:
            q.processAllAvailable()
            spark.createDataFrame([(1,)], "x int").write.mode("overwrite").parquet(marker)
        except BaseException as e:  # noqa: BLE001 - raised below
            failed.append(e)
            q.stop()  # no marker will come
    t = threading.Thread(target=drop_marker)
    t.start()
    stopped = S.stop_on_marker(q, spark, marker, poll_s=0.5, grace_s=0.2)
    t.join()
    if failed:
        raise failed[0]
    if not stopped:
        raise RuntimeError("the query ended before the marker appeared")
    return job.log.read().agg(F.sum("record_count").cast("bigint").alias("records"))


QUERIES: dict[str, Query] = {
    "click_count_by_category": q_click_count_by_category,
    "click_count_by_search": q_click_count_by_search,
    "counter_increment_merge": q_counter_increment_merge,
    "counter_store_replay": q_counter_store_replay,
    "counter_late_batch": q_counter_late_batch,
    "counter_increment_one": q_counter_increment_one,
    "counter_get": q_counter_get,
    "batch_record_count": q_batch_record_count,
    "empty_batch_skip": q_empty_batch_skip,
    "record_sink": q_record_sink,
    "offset_ranges": q_offset_ranges,
    "offset_range_report": q_offset_range_report,
    "offset_encode": q_offset_encode,
    "offset_decode": q_offset_decode,
    "offset_latest": q_offset_latest,
    "offset_found": q_offset_found,
    "offset_add_partitions": q_offset_add_partitions,
    "offset_clamp": q_offset_clamp,
    "offset_paths": q_offset_paths,
    "offset_commit_before": q_offset_commit_before,
    "resume_subscribe": q_resume_subscribe,
    "resume_pushdown": q_resume_pushdown,
    "resume_assign": q_resume_assign,
    "topic_values": q_topic_values,
    "topic_generate": q_topic_generate,
    "cell_put_latest": q_cell_put_latest,
    "cell_put_one": q_cell_put_one,
    "cell_delete": q_cell_delete,
    "get_row": q_get_row,
    "get_rows": q_get_rows,
    "first_row": q_first_row,
    "first_cell_row": q_first_cell_row,
    "range_scan": q_range_scan,
    "filter_scan": q_filter_scan,
    "cell_versions": q_cell_versions,
    "cell_versions_compacted": q_cell_versions_compacted,
    "scan_page": q_scan_page,
    "cell_page_rows": q_cell_page_rows,
    "bucketed_cells": q_bucketed_cells,
    "cell_table_compacted": q_cell_table_compacted,
    "table_scan": q_table_scan,
    "cell_format": q_cell_format,
    "page_first": q_page_first,
    "page_next": q_page_next,
    "page_all": q_page_all,
    "page_summary": q_page_summary,
    "long_to_bytes_hex": q_long_to_bytes_hex,
    "bytes_to_long": q_bytes_to_long,
    "salted_key": q_salted_key,
    "region_skew": q_region_skew,
    "region_get_row": q_region_get_row,
    "region_get_rows": q_region_get_rows,
    "region_range": q_region_range,
    "random_code": q_random_code,
    "random_code_check": q_random_code_check,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "snapshot_table": q_snapshot_table,
    "snapshot_list": q_snapshot_list,
    "snapshot_drop": q_snapshot_drop,
    "snapshot_collect": q_snapshot_collect,
    "stream_counters": q_stream_counters,
    "stream_resume": q_stream_resume,
    "stream_restart_from_log": q_stream_restart_from_log,
    "stream_commit_before_replay": q_stream_commit_before_replay,
    "stream_resume_multi_file": q_stream_resume_multi_file,
    "stream_marker_stop": q_stream_marker_stop,
    "stream_crash_between_writes": q_stream_crash_between_writes,
    "stream_foreach_records": q_stream_foreach_records,
    "stream_clamped_start": q_stream_clamped_start,
    "stream_range_report": q_stream_range_report,
    "stream_counters_state": q_stream_counters_state,
}

# ---- oracles ---------------------------------------------------------------

_REC = "SELECT topic, \"partition\", \"offset\", \"key\", \"value\" FROM"
_LATEST_AT_STOP = ("SELECT group_id, topic, \"partition\", arg_max(until_offset, batch_id) AS \"offset\" "
                   "FROM log_v WHERE batch_id <= (SELECT max(batch_id) // 2 FROM log_v) GROUP BY group_id, topic, \"partition\"")
_SALTED = ("substr('123456789ABCDEF', CAST(('0x' || substr(md5(rowkey), 1, 8))::BIGINT % 15 + 1 AS INTEGER), 1) || '_'"
           " || rowkey AS rowkey")
_PAGED = ("SELECT rowkey, click_count, row_number() OVER (ORDER BY rowkey) AS row_num FROM counters_v")


def _values(rows: list[tuple], cols: str) -> str:
    def lit(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))
    return "(VALUES " + ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows) + f") AS k({cols})"


ORACLE: dict[str, str] = {
    "click_count_by_category": V.SQL_COUNTERS,
    "click_count_by_search": V.SQL_SEARCH_COUNTERS,
    "counter_increment_merge": with_views(
        "SELECT rowkey, CAST(sum(c) AS BIGINT) AS click_count FROM (SELECT batch_id, concat_ws('_', "
        "strftime(\"timestamp\", '%Y%m%d'), CAST(CAST(json_extract_string(\"value\", '$.k') AS INTEGER) AS VARCHAR))"
        " AS rowkey, count(*) AS c FROM topic_v GROUP BY 1, 2) GROUP BY rowkey", "topic_v"),
    "counter_store_replay": V.SQL_COUNTERS,
    "counter_late_batch": V.SQL_COUNTERS,
    "counter_increment_one": with_views(
        "SELECT rowkey, CAST(sum(click_count) AS BIGINT) AS click_count FROM (SELECT * FROM counters_v UNION ALL SELECT * "
        "FROM " + _values(INCREMENTS, "rowkey, click_count") + ") GROUP BY rowkey", "counters_v"),
    "counter_get": with_views(
        "SELECT CAST(k.pos AS INTEGER) AS pos, k.rowkey, COALESCE(c.click_count, 0) AS click_count FROM "
        + _values(list(enumerate(COUNTER_KEYS)), "pos, rowkey") + " LEFT JOIN counters_v c ON c.rowkey = k.rowkey",
        "counters_v"),
    "batch_record_count": with_views(
        "SELECT batch_id, count(*) AS record_count FROM topic_v GROUP BY batch_id", "topic_v"),
    "empty_batch_skip": with_views(
        "SELECT CAST(CASE WHEN batch_id <= half THEN 1 ELSE 3 END AS BIGINT) AS batch_id, count(*) AS records, count(*) "
        "AS logged FROM topic_v, (SELECT max(batch_id) // 2 AS half FROM topic_v) GROUP BY 1", "topic_v"),
    "record_sink": "SELECT count(*) AS records FROM events",
    "offset_ranges": with_views(
        "SELECT l.* EXCLUDE (group_id) FROM log_v l WHERE batch_id < (SELECT max(batch_id) FROM log_v) OR "
        "\"partition\" = 0 UNION ALL SELECT topic, \"partition\", max(until_offset) AS from_offset, max(until_offset) AS "
        "until_offset, CAST(0 AS BIGINT) AS record_count, (SELECT max(batch_id) FROM log_v) AS batch_id FROM log_v "
        "WHERE batch_id < (SELECT max(batch_id) FROM log_v) AND \"partition\" <> 0 GROUP BY topic, \"partition\"", "log_v"),
    "offset_range_report": with_views(
        "SELECT batch_id, '---' || concat_ws(',', topic, CAST(\"partition\" AS VARCHAR), CAST(from_offset AS VARCHAR),"
        " CAST(until_offset AS VARCHAR)) AS line FROM log_v", "log_v"),
    "offset_encode": with_views(
        "SELECT batch_id, string_agg(CAST(\"partition\" AS VARCHAR) || ':' || CAST(until_offset AS VARCHAR), ',' "
        "ORDER BY \"partition\") AS offsets FROM log_v GROUP BY batch_id", "log_v"),
    "offset_decode": with_views(
        "SELECT batch_id, \"partition\", until_offset AS \"offset\" FROM log_v", "log_v"),
    "offset_latest": with_views(
        "SELECT group_id, topic, \"partition\", arg_max(until_offset, batch_id) AS \"offset\" FROM log_v "
        "GROUP BY group_id, topic, \"partition\"", "log_v"),
    "offset_found": with_views(
        "SELECT k.group_id, CAST(CASE WHEN EXISTS (SELECT 1 FROM log_v l WHERE l.group_id = k.group_id AND "
        "l.topic = 'events') THEN 1 ELSE 0 END AS INTEGER) AS found FROM " + _values([("clicks",), ("nobody",)],
                                                                                       "group_id"), "log_v"),
    "offset_add_partitions": with_views(
        "SELECT topic, \"partition\", arg_max(until_offset, batch_id) AS \"offset\" FROM log_v "
        f"WHERE \"partition\" < {OLD_PARTITION_COUNT} GROUP BY topic, \"partition\" UNION ALL "
        "SELECT DISTINCT topic, \"partition\", CAST(0 AS BIGINT) AS \"offset\" FROM topic_v "
        f"WHERE \"partition\" >= {OLD_PARTITION_COUNT}", "log_v"),
    "offset_clamp": with_views(
        f"SELECT s.group_id, s.topic, s.\"partition\", greatest(s.\"offset\", coalesce(e.earliest, s.\"offset\")) "
        f"AS \"offset\" FROM ({_LATEST_AT_STOP}) s LEFT JOIN (SELECT topic, \"partition\", min(\"offset\") AS earliest"
        " FROM topic_v WHERE batch_id >= \"partition\" + (SELECT max(batch_id) // 3 FROM topic_v) GROUP BY topic, \"partition\") e "
        "ON s.topic = e.topic AND s.\"partition\" = e.\"partition\"", "log_v"),
    "offset_paths": with_views(
        "SELECT concat_ws('/', '/kafka/offsets', group_id, topic, CAST(\"partition\" AS VARCHAR)) AS path, "
        "CAST(arg_max(until_offset, batch_id) AS VARCHAR) AS data FROM log_v GROUP BY group_id, topic, \"partition\"",
        "log_v"),
    "offset_commit_before": with_views(
        f"{_REC} topic_v t WHERE NOT EXISTS (SELECT 1 FROM (SELECT topic, \"partition\", arg_max(from_offset, batch_id)"
        " AS s FROM log_v GROUP BY topic, \"partition\") p WHERE p.topic = t.topic AND p.\"partition\" = t.\"partition\""
        " AND t.\"offset\" < p.s)", "log_v"),
    "resume_subscribe": with_views(
        f"{_REC} topic_v t WHERE NOT EXISTS (SELECT 1 FROM ({_LATEST_AT_STOP}) p WHERE p.\"partition\" IN "
        f"{tuple(STORED_PARTITIONS)} AND p.topic = t.topic AND p.\"partition\" = t.\"partition\" "
        "AND t.\"offset\" < p.\"offset\")", "log_v"),
    "resume_pushdown": None,  # filled below: same rows as resume_subscribe
    "resume_assign": with_views(
        f"SELECT t.topic, t.\"partition\", t.\"offset\", t.\"key\", t.\"value\" FROM topic_v t JOIN "
        f"({_LATEST_AT_STOP}) p ON p.topic = t.topic AND p.\"partition\" = t.\"partition\" WHERE p.\"partition\" IN "
        f"{tuple(STORED_PARTITIONS)} AND t.\"offset\" >= p.\"offset\"", "log_v"),
    "topic_values": with_views(
        "SELECT topic, \"partition\", \"offset\", \"value\" FROM topic_v WHERE topic IN ('events')", "topic_v"),
    "topic_generate": ("SELECT CAST(event_id + 1 AS VARCHAR) AS \"key\", 'hlw:' || strftime(ts, '%Y-%m-%d %H:%M:%S')"
                       " AS \"value\" FROM events"),
    "cell_put_latest": with_views(
        "SELECT rowkey, cf, qualifier, ts, seq, value_text FROM (SELECT *, row_number() OVER (PARTITION BY rowkey, cf,"
        " qualifier ORDER BY ts DESC, seq DESC) AS rn FROM (SELECT rowkey, cf, qualifier, CASE WHEN seq * 2 > n AND "
        "seq % 3 = 0 THEN n - seq ELSE ts END AS ts, seq, value_text FROM cells_v, (SELECT max(event_id) AS n FROM "
        "events))) WHERE rn = 1", "cells_v"),
    "cell_put_one": with_views(
        "SELECT l.rowkey, l.cf, l.qualifier, CASE WHEN a.seq IS NULL THEN l.ts ELSE "
        f"{PUT_TS} END AS ts, CASE WHEN a.seq IS NULL THEN l.value_text ELSE 'again ' || a.seq END AS value_text FROM "
        "latest_v l LEFT JOIN (SELECT qualifier, arg_max(rowkey, seq) AS rowkey, max(seq) AS seq FROM cells_v GROUP BY "
        "qualifier) a ON l.rowkey = a.rowkey AND l.qualifier = a.qualifier", "latest_v"),
    "cell_versions_compacted": with_views("SELECT * FROM cells_v", "cells_v"),
    "cell_delete": with_views(
        "SELECT * FROM cells_v WHERE rowkey NOT IN (" + ", ".join(f"'{k}'" for k in DELETE_KEYS) + ")", "cells_v"),
    "get_row": with_views("SELECT * FROM latest_v WHERE rowkey = 'u5'", "latest_v"),
    "get_rows": with_views(
        "SELECT CAST(k.pos AS INTEGER) AS pos, k.rowkey, l.cf, l.qualifier, l.ts, l.seq, l.value_text FROM "
        + _values(list(enumerate(CELL_KEYS)), "pos, rowkey") + " LEFT JOIN latest_v l ON l.rowkey = k.rowkey",
        "latest_v"),
    "first_row": with_views(
        "SELECT rowkey, click_count FROM counters_v WHERE click_count >= 5 ORDER BY rowkey LIMIT 1", "counters_v"),
    "first_cell_row": with_views(
        "SELECT * FROM latest_v WHERE qualifier <> 'error' AND rowkey = (SELECT min(rowkey) FROM latest_v "
        "WHERE qualifier <> 'error')", "latest_v"),
    "range_scan": with_views(
        "SELECT rowkey, click_count FROM counters_v WHERE rowkey >= '20240105' AND rowkey < '20240106'",
        "counters_v"),
    "filter_scan": with_views(
        "SELECT rowkey, click_count FROM counters_v WHERE click_count >= 5 AND suffix(rowkey, '7')", "counters_v"),
    "cell_versions": with_views(
        "SELECT rowkey, cf, qualifier, ts, seq, CAST(version AS INTEGER) AS version FROM (SELECT *, row_number() OVER"
        " (PARTITION BY rowkey, cf, qualifier ORDER BY ts DESC, seq DESC) AS version FROM cells_v) WHERE version <= 3",
        "cells_v"),
    "scan_page": with_views(
        "SELECT CAST(version AS INTEGER) AS version, rowkey, cf, qualifier, ts, seq, value_text FROM (SELECT *, "
        "row_number() OVER (PARTITION BY rowkey, cf, qualifier ORDER BY ts DESC, seq DESC) AS version FROM cells_v "
        "WHERE rowkey >= 'u1' AND rowkey < 'u5' AND qualifier <> 'error') WHERE version <= 2 AND rowkey IN "
        "(SELECT DISTINCT rowkey FROM cells_v WHERE rowkey >= 'u1' AND rowkey < 'u5' AND qualifier <> 'error' "
        "ORDER BY rowkey LIMIT 10)", "cells_v"),
    "cell_page_rows": with_views(
        "SELECT * FROM latest_v WHERE rowkey IN (SELECT DISTINCT rowkey FROM latest_v WHERE rowkey > 'u105' "
        "ORDER BY rowkey LIMIT 10)", "latest_v"),
    "bucketed_cells": with_views(
        "SELECT * FROM latest_v WHERE rowkey NOT IN (" + ", ".join(f"'{k}'" for k in DELETE_KEYS) + ")", "latest_v"),
    "table_scan": with_views("SELECT * FROM latest_v", "latest_v"),
    "cell_format": with_views(
        "SELECT rowkey, cf, qualifier, value_text, ts, cf || ':' || qualifier || '=' || value_text || ' @' || "
        "CAST(ts AS VARCHAR) AS line FROM latest_v", "latest_v"),
    "page_first": with_views(
        f"SELECT rowkey, click_count FROM counters_v ORDER BY rowkey LIMIT {V.PAGE_SIZE}", "counters_v"),
    "page_next": with_views(
        f"SELECT rowkey, click_count FROM counters_v ORDER BY rowkey LIMIT {V.PAGE_SIZE} OFFSET {V.PAGE_SIZE}",
        "counters_v"),
    "page_all": with_views(
        f"SELECT rowkey, click_count, row_num, CAST((row_num - 1) // {V.PAGE_SIZE} + 1 AS INTEGER) AS page_index "
        f"FROM ({_PAGED})", "counters_v"),
    "page_summary": with_views(
        f"SELECT page_index, start_key, end_key, CAST((page_index - 1) * {V.PAGE_SIZE} + 1 AS BIGINT) AS first_row, "
        "CAST(CASE WHEN page_index > 1 THEN page_index - 1 ELSE 1 END AS INTEGER) AS prev_page, "
        f"CAST(page_index + 1 AS INTEGER) AS next_page, rows = {V.PAGE_SIZE} AS has_next, "
        f"last_row < (SELECT count(*) FROM counters_v) AS has_next_exact, rows, "
        f"CAST((page_index - 1) * {V.PAGE_SIZE} + rows AS BIGINT) AS total FROM ("
        f"SELECT CAST((row_num - 1) // {V.PAGE_SIZE} + 1 AS INTEGER) AS page_index, min(rowkey) AS start_key, "
        f"max(rowkey) AS end_key, count(*) AS rows, max(row_num) AS last_row FROM ({_PAGED}) GROUP BY 1)",
        "counters_v"),
    "long_to_bytes_hex": ("SELECT event_id, (500 - event_id) * 1000003 AS n, printf('%016X', (500 - event_id) * 1000003)"
                          " AS hex FROM events"),
    "bytes_to_long": "SELECT event_id, (500 - event_id) * 1000003 AS n, (500 - event_id) * 1000003 AS decoded FROM events",
    "salted_key": with_views(
        "SELECT rowkey, substr('123456789ABCDEF', CAST(('0x' || substr(md5(rowkey), 1, 8))::BIGINT % 15 + 1 AS INTEGER)"
        ", 1) || '_' || rowkey AS salted FROM counters_v", "counters_v"),
    "region_skew": with_views(
        "SELECT CAST(len(list_filter(['1','2','3','4','5','6','7','8','9','A','B','C','D','E','F'], "
        "lambda s: s <= salted)) AS INTEGER) AS region, count(*) AS keys FROM (SELECT substr('123456789ABCDEF', "
        "CAST(('0x' || substr(md5(rowkey), 1, 8))::BIGINT % 15 + 1 AS INTEGER), 1) || '_' || rowkey AS salted "
        "FROM counters_v) GROUP BY 1", "counters_v"),
    "region_get_row": with_views(
        f"SELECT {_SALTED}, * EXCLUDE (rowkey) FROM latest_v WHERE rowkey = 'u5'", "latest_v"),
    "region_get_rows": with_views(
        f"SELECT CAST(k.pos AS INTEGER) AS pos, {_SALTED.replace('rowkey', 'k.rowkey', 2)}, l.cf, l.qualifier, l.ts, "
        "l.seq, l.value_text FROM " + _values(list(enumerate(CELL_KEYS)), "pos, rowkey")
        + " LEFT JOIN latest_v l ON l.rowkey = k.rowkey", "latest_v"),
    "region_range": with_views(
        f"SELECT * FROM (SELECT {_SALTED}, * EXCLUDE (rowkey) FROM latest_v) WHERE rowkey >= '4_u3' AND rowkey < 'B'",
        "latest_v"),
    "random_code_check": ("SELECT count(*) AS codes, CAST(8 AS INTEGER) AS shortest, CAST(8 AS INTEGER) AS longest, "
                          "CAST(0 AS BIGINT) AS other_characters, true AS vary FROM events"),
    "snapshot_roundtrip": with_views("SELECT * FROM latest_v", "latest_v"),
    "snapshot_table": with_views(
        "SELECT rowkey, cf, qualifier, ts, seq, value_text FROM (SELECT *, row_number() OVER (PARTITION BY rowkey, "
        "cf, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM cells_v WHERE seq * 2 <= (SELECT max(event_id) "
        "FROM events)) WHERE rn = 1", "cells_v"),
    # removed: the copy, the first put (in the first base) and the delete (in the second base); the first base and the
    # second put serve the snapshot that is left
    "snapshot_collect": with_views(
        "SELECT 'all' AS name, CAST(3 AS INTEGER) AS folders_removed, * FROM latest_v UNION ALL "
        "SELECT 'table' AS name, CAST(3 AS INTEGER) AS folders_removed, * FROM latest_v WHERE rowkey NOT IN ("
        + ", ".join(f"'{k}'" for k in DELETE_KEYS) + ")", "latest_v"),
    "snapshot_list": with_views(
        "SELECT 'daily_a' AS snapshot_name, count(*) AS rows FROM counters_v UNION ALL "
        "SELECT 'daily_b' AS snapshot_name, count(*) AS rows FROM search_v", "counters_v", "search_v"),
    "snapshot_drop": with_views(
        "SELECT 'weekly_a' AS snapshot_name, count(*) AS rows FROM latest_v", "latest_v"),
    "stream_counters": V.SQL_COUNTERS,
    "stream_resume": V.SQL_COUNTERS,
    "stream_restart_from_log": V.SQL_COUNTERS,
    "stream_commit_before_replay": with_views("SELECT topic, \"partition\", \"offset\" FROM topic_v", "topic_v"),
    "stream_resume_multi_file": V.SQL_COUNTERS,
    "stream_marker_stop": "SELECT count(*) AS records FROM events",
    "stream_crash_between_writes": V.SQL_COUNTERS,
    "stream_foreach_records": with_views(
        "SELECT topic, \"partition\", count(*) AS records, count(DISTINCT \"offset\") AS offsets, "
        "min(\"offset\") AS first, max(\"offset\") AS last FROM topic_v GROUP BY ALL", "topic_v"),
    "stream_clamped_start": with_views(
        ", top AS (SELECT max(\"offset\") + 1 AS n FROM topic_v), parts AS (SELECT topic, \"partition\", "
        "max(\"offset\") FILTER (\"offset\" < n // 4) + 1 AS stored, min(\"offset\") FILTER (\"offset\" >= n // 2) AS begins, "
        "count(*) FILTER (\"offset\" < n // 4 OR \"offset\" >= n // 2) AS records FROM topic_v, top GROUP BY ALL) "
        "SELECT 'expired' AS kind, topic, \"partition\", stored, begins, begins - stored AS lost, records FROM parts",
        "topic_v"),
    "stream_range_report": with_views(
        ", b AS (SELECT min(\"offset\") AS lo, (max(\"offset\") - min(\"offset\")) // 4 + 1 AS step FROM topic_v) "
        "SELECT (\"offset\" - lo) // step AS batch_id, count(*) AS input_rows, count(*) AS logged_rows, "
        "count(DISTINCT \"partition\") AS partitions FROM topic_v, b GROUP BY 1", "topic_v"),
    "stream_counters_state": V.SQL_COUNTERS,
}

ORACLE["resume_pushdown"] = ORACLE["resume_subscribe"]
ORACLE["cell_table_compacted"] = ORACLE["bucketed_cells"]
