from pyspark.sql import functions as F

from tidemark.operators.offsets import (OffsetLog, add_new_partitions, clamp_to_earliest, latest_offsets,
                                        offset_ranges, range_report, resume_assign, resume_subscribe,
                                        start_positions)

REC = "topic string, partition int, offset bigint"


def test_new_partition_starts_at_zero(spark):
    stored = spark.createDataFrame([("t", 0, 12), ("t", 1, 15)], REC)
    current = spark.createDataFrame([("t", 0), ("t", 1), ("t", 2)], "topic string, partition int")
    got = sorted(tuple(r) for r in add_new_partitions(stored, current).collect())
    assert got == [("t", 0, 12), ("t", 1, 15), ("t", 2, 0)]


def test_clamp_to_earliest(spark):
    stored = spark.createDataFrame([("t", 0, 123), ("t", 1, 500), ("t", 2, 7)], REC)
    earliest = spark.createDataFrame([("t", 0, 200), ("t", 1, 200)], "topic string, partition int, earliest bigint")
    got = sorted(tuple(r) for r in clamp_to_earliest(stored, earliest).collect())
    assert got == [("t", 0, 200), ("t", 1, 500), ("t", 2, 7)]


def test_offset_ranges_and_idle_partitions(spark):
    batch = spark.createDataFrame([("t", 0, 10), ("t", 0, 11), ("t", 0, 13), ("t", 1, 5)], REC)
    prev = spark.createDataFrame([("t", 0, 10), ("t", 1, 5), ("t", 2, 40)], REC)
    got = sorted(tuple(r) for r in offset_ranges(batch, previous=prev)
                 .select("partition", "from_offset", "until_offset", "record_count").collect())
    # partition 0 has a gap (compacted topic): count 3 < until - from = 4
    assert got == [(0, 10, 14, 3), (1, 5, 6, 1), (2, 40, 40, 0)]
    line = range_report(offset_ranges(batch)).filter("partition = 1").first()["line"]
    assert line == "---t,1,5,6"


def test_offset_log_replay_and_latest(spark, tmp_root):
    log = OffsetLog(spark, f"{tmp_root}/log")
    assert log.get_offsets("g", ["t"])[1] == 0  # nothing stored
    r0 = spark.createDataFrame([("t", 0, 0, 10, 10), ("t", 1, 0, 5, 5)],
                               "topic string, partition int, from_offset bigint, until_offset bigint, "
                               "record_count bigint")
    log.append(r0, "g", "run1", 0)
    r1 = spark.createDataFrame([("t", 0, 10, 20, 10)],
                               "topic string, partition int, from_offset bigint, until_offset bigint, "
                               "record_count bigint")
    log.append(r1, "g", "run1", 1)
    log.append(r1, "g", "run1", 1)  # replayed batch replaces its rows
    assert log.read().count() == 3
    df, found = log.get_offsets("g", ["t"])
    assert found == 1
    assert sorted((r.partition, r.offset) for r in df.collect()) == [(0, 20), (1, 5)]
    # commit-before position is the from of the newest batch per partition
    before = sorted((r.partition, r.offset) for r in log.latest("g", ["t"], commit="before").collect())
    assert before == [(0, 10), (1, 0)]
    # another group sees nothing
    assert log.get_offsets("other", ["t"])[1] == 0
    # a newer run wins over a higher batch id of an older run
    log.append(r0.withColumn("until_offset", F.lit(99).cast("bigint")), "g", "run2", 0)
    assert sorted((r.partition, r.offset) for r in log.latest("g").collect()) == [(0, 99), (1, 99)]


def test_latest_offsets_by_batch(spark):
    log = spark.createDataFrame(
        [("g", "t", 0, 0, 5, 0), ("g", "t", 0, 5, 9, 1), ("g", "t", 1, 0, 3, 0)],
        "group_id string, topic string, partition int, from_offset bigint, until_offset bigint, batch_id bigint")
    got = sorted((r.partition, r.offset) for r in latest_offsets(log, "g").collect())
    assert got == [(0, 9), (1, 3)]
    got = sorted((r.partition, r.offset) for r in start_positions(log, "g", "before").collect())
    assert got == [(0, 5), (1, 0)]


def test_resume_subscribe_and_assign(spark):
    rec = spark.createDataFrame([("t", p, o) for p in range(3) for o in range(10)], REC)
    stored = spark.createDataFrame([("t", 0, 7), ("t", 1, 10)], REC)
    sub = resume_subscribe(rec, stored)
    assert sorted((r.partition, r.offset) for r in sub.collect()) == \
        [(0, 7), (0, 8), (0, 9)] + [(2, o) for o in range(10)]
    assert resume_subscribe(rec, stored, default_start="latest").count() == 3
    asg = resume_assign(rec, stored)
    assert sorted((r.partition, r.offset) for r in asg.collect()) == [(0, 7), (0, 8), (0, 9)]


def test_offset_paths_roundtrip(spark):
    from tidemark.operators.offsets import offset_paths, offsets_from_paths
    latest = spark.createDataFrame([("g", "t", 0, 12), ("g", "t", 3, 900)],
                                   "group_id string, topic string, partition int, offset bigint")
    paths = offset_paths(latest)
    assert sorted(tuple(r) for r in paths.collect()) == [("/kafka/offsets/g/t/0", "12"),
                                                        ("/kafka/offsets/g/t/3", "900")]
    back = sorted(tuple(r) for r in offsets_from_paths(paths).collect())
    assert back == [("g", "t", 0, 12), ("g", "t", 3, 900)]
    bad = spark.createDataFrame([("/kafka/offsets/g/t/x", "1")], "path string, data string")
    import pytest
    with pytest.raises(Exception):
        offsets_from_paths(bad).collect()


def test_sql_offset_table_mapping(spark):
    from tidemark.operators.offsets import from_sql_offset_table
    sql_rows = spark.createDataFrame([("t", "g", 0, 5, 9), ("t", "g", 1, 0, 3), ("t", "other", 0, 0, 1)],
                                     "topic string, groupid string, partitions int, fromoffset bigint, "
                                     "untiloffset bigint")
    got = sorted((r.partition, r.offset) for r in latest_offsets(from_sql_offset_table(sql_rows), "g").collect())
    assert got == [(0, 9), (1, 3)]


def test_default_start_names():
    import pytest

    from tidemark.sources.topic import default_start
    assert default_start("smallest") == "earliest" and default_start("largest") == "latest"
    assert default_start(" Earliest ") == "earliest"
    with pytest.raises(ValueError):
        default_start("none")


def test_positions_predicate_pushed_and_equal(spark, tmp_root):
    import tidemark.operators.offsets as O
    rec = spark.createDataFrame([("t", p, o) for p in range(4) for o in range(200)], REC)
    rec.repartitionByRange(8, "partition", "offset").sortWithinPartitions("partition", "offset") \
        .write.parquet(f"{tmp_root}/topic")
    files = spark.read.parquet(f"{tmp_root}/topic")
    pos = [("t", 0, 150), ("t", 2, 10)]
    stored = spark.createDataFrame(pos, REC)
    for assign in (False, True):
        a = O.resume_from_positions(files, pos, assign=assign)
        b = resume_assign(files, stored) if assign else resume_subscribe(files, stored)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(offset,150)" in plan  # reaches the parquet scan
    # the same path at any partition count
    many = [("t", p, 150) for p in range(3000)]
    plan = O.resume_from_positions(files, many)
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count() == files.where("offset >= 150").count()
    assert O.resume_from_positions(files, [], assign=True).count() == 0
    assert O.resume_from_positions(files, []).count() == 800
