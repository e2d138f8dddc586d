from pyspark.sql import functions as F

from tidemark.operators.counters import (CounterStore, clicks_per_day_category, clicks_per_day_search_category,
                                         lookup_counters, merge_increments)

SAMPLE = [("20171122_1", 300), ("20171122_9", 60), ("20171122_10", 160)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "rowkey string, click_count bigint")


def test_counter_add_into_empty(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.add(_df(spark, SAMPLE), batch_id=0)
    got = [tuple(r) for r in st.read().orderBy("rowkey").collect()]
    assert got == [("20171122_1", 300), ("20171122_10", 160), ("20171122_9", 60)]


def test_counter_add_twice_and_replay(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.add(_df(spark, SAMPLE), batch_id=0)
    st.add(_df(spark, SAMPLE), batch_id=1)
    assert dict(st.read().collect()) == {"20171122_1": 600, "20171122_9": 120, "20171122_10": 320}
    # replaying batch 1 replaces its delta instead of adding it again
    st.add(_df(spark, SAMPLE), batch_id=1)
    assert dict(st.read().collect()) == {"20171122_1": 600, "20171122_9": 120, "20171122_10": 320}


def test_counter_replay_same_batch(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.add(_df(spark, SAMPLE), batch_id=5)
    st.add(_df(spark, SAMPLE), batch_id=5)
    assert dict(st.read().collect()) == dict(SAMPLE)


def test_absent_counter_is_zero(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.add(_df(spark, SAMPLE), batch_id=0)
    got = st.get(["20991231_0", "20171122_9"]).orderBy("pos").select("rowkey", "click_count").collect()
    assert [tuple(r) for r in got] == [("20991231_0", 0), ("20171122_9", 60)]


def test_single_increment_and_compaction(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.add(_df(spark, SAMPLE), batch_id=0)
    st.increment("20171122_1", 5, batch_id=1)
    st.compact()
    assert dict(st.read().collect())["20171122_1"] == 305
    # a covered batch replayed after compaction is not counted twice
    st.increment("20171122_1", 5, batch_id=1)
    assert dict(st.read().collect())["20171122_1"] == 305
    st.add(_df(spark, SAMPLE), batch_id=2)
    st.compact()
    assert dict(st.read().collect()) == {"20171122_1": 605, "20171122_9": 120, "20171122_10": 320}


def test_merge_increments_and_lookup(spark):
    inc = _df(spark, SAMPLE + SAMPLE + [("20171122_1", 1)])
    merged = merge_increments(inc)
    assert dict(merged.collect()) == {"20171122_1": 601, "20171122_9": 120, "20171122_10": 320}
    got = lookup_counters(merged, ["x", "20171122_10"]).orderBy("pos").select("rowkey", "click_count").collect()
    assert [tuple(r) for r in got] == [("x", 0), ("20171122_10", 320)]


def test_clicks_per_day_category_and_search(spark):
    clicks = spark.createDataFrame(
        [("2017-11-22 10:00:00", 1, "baidu"), ("2017-11-22 11:00:00", 1, "sogou"),
         ("2017-11-22 23:59:59", 1, "baidu"), ("2017-11-23 00:00:00", 1, "baidu")],
        "t string, category_id int, refer string").withColumn("ts", F.to_timestamp_ntz("t"))
    a = dict(clicks_per_day_category(clicks).collect())
    assert a == {"20171122_1": 3, "20171123_1": 1}
    b = dict(clicks_per_day_search_category(clicks).collect())
    assert b == {"20171122_baidu_1": 2, "20171122_sogou_1": 1, "20171123_baidu_1": 1}


def test_half_done_compaction_is_ignored(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.add(_df(spark, SAMPLE), batch_id=0)
    st.compact()
    st.add(_df(spark, SAMPLE), batch_id=1)
    # a compaction that wrote its counters but died before committing
    _df(spark, [("20171122_1", 999)]).write.parquet(f"{tmp_root}/base/v=7/counters")
    assert dict(st.read().collect())["20171122_1"] == 600
    st.compact()  # the next compaction goes above the broken version
    assert dict(st.read().collect())["20171122_1"] == 600


def test_counter_get_pushes_key_filter(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.add(_df(spark, SAMPLE), batch_id=0)
    st.compact()
    st.add(_df(spark, SAMPLE), batch_id=1)
    got = st.get(["20171122_9"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    span = "GreaterThanOrEqual(rowkey,20171122_9), LessThanOrEqual(rowkey,20171122_9)"
    assert plan.count(span) >= 2  # base and deltas
    assert [tuple(r) for r in got.select("rowkey", "click_count").collect()] == [("20171122_9", 120)]


def test_late_batch_counts_after_compaction(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    for b in (0, 1, 5):
        st.increment("a", 1, batch_id=b)
    st.compact()
    st.increment("a", 10, batch_id=3)
    assert dict(st.read().collect()) == {"a": 13}
    st.compact()
    st.increment("a", 10, batch_id=3)  # a replay
    assert dict(st.read().collect()) == {"a": 13}


def test_every_increment_adds_and_stores_do_not_meet(spark, tmp_root):
    a, b = CounterStore(spark, tmp_root), CounterStore(spark, tmp_root)
    assert a.run_id != b.run_id
    for st in (a, b, a):
        st.increment("k", 2)
    assert dict(a.read().collect()) == {"k": 6}
    a.compact()
    assert a.vacuum(older_than_s=0) == 3
    b.increment("k", 1)
    a.compact()
    assert dict(b.read().collect()) == {"k": 7}


def test_folded_deltas_are_not_opened(spark, tmp_root):
    st = CounterStore(spark, tmp_root, run_id="r1")
    for b in range(3):
        st.add(_df(spark, SAMPLE), batch_id=b)
    st.compact()
    assert not [f for f in st.read().inputFiles() if "/deltas/" in f]
    assert st.vacuum() == 0  # within the retention time
    assert st.vacuum(older_than_s=0) == 3
    st.add(_df(spark, SAMPLE), batch_id=1)  # a replay of a folded, removed batch
    assert dict(st.read().collect())["20171122_1"] == 900


def test_batch_that_lands_during_compaction_counts_once(spark, tmp_root, monkeypatch):
    st = CounterStore(spark, tmp_root, run_id="r1")
    st.increment("a", 1, batch_id=0)
    summed = st._sum

    def slow(base, batches):
        st.increment("a", 10, batch_id=1)
        return summed(base, batches)
    monkeypatch.setattr(st, "_sum", slow)
    st.compact()
    monkeypatch.undo()
    assert dict(st.read().collect()) == {"a": 11}
    st.compact()
    assert dict(st.read().collect()) == {"a": 11}
