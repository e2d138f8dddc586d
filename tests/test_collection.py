"""Freeing what dropped snapshots held."""

import pytest

from tidemark.functions.codecs import from_utf8
from tidemark.operators.cells import CellTable, make_put
from tidemark.operators.snapshots import SnapshotStore
from tidemark.session import create_file, list_dirs, list_files, stored_bytes


def _put(spark, t, rows, ts):
    return t.put(make_put(spark, [(k, "info", "x", v) for k, v in rows], ts=ts))


def _view(df):
    return sorted((r.rowkey, r.v) for r in df.select("rowkey", from_utf8("value").alias("v")).collect())


def test_dropped_copies_are_freed_after_the_grace_time(spark, tmp_root):
    st = SnapshotStore(spark, tmp_root)
    st.take("a", spark.range(1000).toDF("x"))
    st.take("b", spark.range(500).toDF("x"))
    both = stored_bytes(spark, f"{tmp_root}/copies")
    assert st.collect_garbage(0) == []  # both are live
    st.drop("a")
    assert st.collect_garbage(3600) == [] and stored_bytes(spark, f"{tmp_root}/copies") == both
    spark.range(5).write.parquet(f"{tmp_root}/copies/left-by-a-dead-taker")
    assert len(st.collect_garbage(3600)) == 0 and len(st.collect_garbage(0)) == 2
    assert 0 < stored_bytes(spark, f"{tmp_root}/copies") < both
    assert st.read("b").count() == 500
    assert st.collect_garbage(0) == []
    st.take("a", spark.range(7).toDF("x"))  # the name's next life
    assert st.collect_garbage(0) == [] and st.read("a").count() == 7


def test_operations_are_freed_up_to_what_snapshots_need(spark, tmp_root):
    t, st = CellTable(spark, f"{tmp_root}/t"), SnapshotStore(spark, f"{tmp_root}/s")
    _put(spark, t, [("a", "1"), ("b", "1")], 1)
    st.take_table("one", t)
    _put(spark, t, [("a", "2")], 2)
    t.compact()
    _put(spark, t, [("c", "3")], 3)
    st.take_table("three", t)
    t.delete(["b"])
    _put(spark, t, [("d", "5")], 5)
    assert t.collect_garbage(3600) == []  # the base is too young
    t.compact()
    now = _view(t.scan())
    one, three = _view(st.read("one")), _view(st.read("three"))
    size = stored_bytes(spark, f"{tmp_root}/t")
    # "one" needs puts/0; "three" the first base and puts/2
    assert sorted(st.collect_garbage(0)) == [f"{tmp_root}/t/{d}" for d in ("deletes/op=3", "puts/op=1", "puts/op=4")]
    assert _view(st.read("one")) == one == [("a", "1"), ("b", "1")]
    assert _view(st.read("three")) == three == [("a", "2"), ("b", "1"), ("c", "3")]
    assert _view(t.scan()) == now == [("a", "2"), ("c", "3"), ("d", "5")]
    st.drop("one")
    st.drop("three")
    assert st.collect_garbage(3600) == []
    assert len(st.collect_garbage(0)) == 3  # two puts and the first base
    assert _view(t.scan()) == now and stored_bytes(spark, f"{tmp_root}/t") < size
    assert list_files(spark, f"{tmp_root}/t/pins") == []
    # later work goes on behind the collected operations
    assert _put(spark, t, [("e", "6")], 6) == 5
    assert _view(t.scan())[-1] == ("e", "6") and _view(t.scan(as_of=4)) == now


def test_a_read_of_collected_operations_is_refused(spark, tmp_root):
    t = CellTable(spark, tmp_root)
    _put(spark, t, [("a", "1")], 1)
    _put(spark, t, [("a", "2")], 2)
    t.compact()
    assert _view(t.scan(as_of=0)) == [("a", "1")]
    assert sorted(t.collect_garbage(0)) == ["puts/op=0", "puts/op=1"]
    with pytest.raises(LookupError):
        t.scan(as_of=0)
    with pytest.raises(LookupError):
        t.pin(0)
    assert list_files(spark, f"{tmp_root}/pins") == []
    assert _view(t.scan()) == _view(t.scan(as_of=1)) == [("a", "2")]
    # a run that died after its marks is taken up
    _put(spark, t, [("a", "3")], 3)
    t.compact()
    create_file(spark, f"{tmp_root}/collected/2")
    assert sorted(t.collect_garbage(0)) == ["base/v=1-whole", "puts/op=2"]
    assert _view(t.scan()) == [("a", "3")]


def test_a_base_of_newest_versions_holds_nothing_up(spark, tmp_root):
    t = CellTable(spark, tmp_root)
    _put(spark, t, [("a", "1")], 1)
    _put(spark, t, [("a", "2")], 2)
    t.compact(keep_versions=1)
    assert t.collect_garbage(0) == []  # reads as of an operation need every version
    assert _view(t.scan(as_of=0)) == [("a", "1")]
    _put(spark, t, [("a", "3")], 3)
    t.compact()
    assert sorted(t.collect_garbage(0)) == ["base/v=1-newest", "puts/op=0", "puts/op=1", "puts/op=2"]
    assert _view(t.scan()) == [("a", "3")]


def test_a_slow_writer_keeps_its_operation(spark, tmp_root):
    t = CellTable(spark, tmp_root)
    _put(spark, t, [("a", "1")], 1)
    slow = t._claim_op()
    _put(spark, t, [("b", "1")], 1)
    t.compact()  # as of operation 0
    assert t.collect_garbage(0) == ["puts/op=0"]
    assert _view(t.scan()) == [("a", "1"), ("b", "1")]
    t.abandon(slow)
    t.compact()
    assert sorted(t.collect_garbage(0)) == ["base/v=0-whole", "puts/op=2"]
    assert _view(t.scan()) == [("a", "1"), ("b", "1")]


def test_one_of_two_takers_gets_a_name(spark, tmp_root):
    st = SnapshotStore(spark, tmp_root)
    with st._claimed("s"):  # another taker is at work
        with pytest.raises(ValueError):
            st.take("s", spark.range(3).toDF("x"))
        with pytest.raises(ValueError):
            st.take_table("s", CellTable(spark, f"{tmp_root}/t"))
    st.release("s")  # it died without recording
    st.take("s", spark.range(3).toDF("x"))
    st.release("s")  # no effect on a live name
    with pytest.raises(ValueError):
        st.take("s", spark.range(4).toDF("x"))
    st.drop("s")
    with pytest.raises(RuntimeError):
        with st._claimed("s"):
            raise RuntimeError("while taking")
    st.take("s", spark.range(4).toDF("x"))  # given back
    assert st.read("s").count() == 4 and len(list_dirs(spark, f"{tmp_root}/copies")) == 2
