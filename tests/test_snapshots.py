import pytest

from tidemark.operators.snapshots import SnapshotStore


def test_snapshot_lifecycle(spark, tmp_root):
    st = SnapshotStore(spark, tmp_root)
    src = spark.range(10).toDF("x")
    st.take("daily_1", src)
    st.take("daily_2", src.filter("x < 5"))
    st.take("weekly_1", src)
    with pytest.raises(ValueError):
        st.take("daily_1", src)
    assert st.read("daily_2").count() == 5
    names = lambda df: sorted(r.snapshot_name for r in df.collect())
    assert names(st.list("daily_.*")) == ["daily_1", "daily_2"]
    assert names(st.list("")) == ["daily_1", "daily_2", "weekly_1"]
    assert names(st.list(None)) == ["daily_1", "daily_2", "weekly_1"]
    with pytest.raises(ValueError):
        st.drop_matching("  ")
    with pytest.raises(ValueError):
        st.drop("")
    assert sorted(st.drop_matching("daily_.*")) == ["daily_1", "daily_2"]
    assert names(st.list("")) == ["weekly_1"]
    assert st.drop("weekly_1") is True and st.drop("weekly_1") is False
    # a dropped name can be taken again with a new copy
    st.take("daily_1", src.filter("x < 2"))
    assert st.read("daily_1").count() == 2


def test_table_snapshot_without_copy(spark, tmp_root):
    from tidemark.functions.codecs import from_utf8
    from tidemark.operators.cells import BucketedCellTable, CellTable, make_put
    from tidemark.session import list_dirs
    for kind in ("folders", "bucketed"):
        root = f"{tmp_root}/{kind}"
        t = CellTable(spark, f"{root}/t") if kind == "folders" else BucketedCellTable(spark, f"{root}/t", 4)
        st = SnapshotStore(spark, f"{root}/snaps")
        t.put(make_put(spark, [("a", "info", "x", "1"), ("b", "info", "x", "2")], ts=1000))
        assert st.take_table("before", t) == 0
        t.put(make_put(spark, [("a", "info", "x", "3")], ts=2000))
        t.delete(["b"])
        view = lambda df: {(r.rowkey, r.v) for r in df.select("rowkey", from_utf8("value").alias("v")).collect()}
        assert view(st.read("before")) == {("a", "1"), ("b", "2")}
        assert view(t.scan()) == {("a", "3")}
        assert list_dirs(spark, f"{root}/snaps/copies") == []  # nothing copied
        assert sorted(r.snapshot_name for r in st.list("").collect()) == ["before"]


def test_take_after_drop_same_millisecond(spark, tmp_root, monkeypatch):
    import tidemark.operators.snapshots as snaps
    st = SnapshotStore(spark, tmp_root)
    monkeypatch.setattr(snaps.time, "time", lambda: 1_700_000_000.0)  # frozen clock
    src = spark.range(3).toDF("x")
    st.take("s", src)
    st.drop("s")
    st.take("s", src.filter("x = 0"))
    assert st.read("s").count() == 1
    assert [r.snapshot_name for r in st.list("").collect()] == ["s"]


def test_one_regex_dialect(spark, tmp_root):
    from tidemark.operators.snapshots import SnapshotStore
    store = SnapshotStore(spark, tmp_root)
    for name in ("daily_a", "daily_B"):
        store.take(name, spark.range(1))
    pattern = r"\p{Lower}+_a"
    assert [r["snapshot_name"] for r in store.list(pattern).collect()] == ["daily_a"]
    assert store.drop_matching(pattern) == ["daily_a"]
    assert [r["snapshot_name"] for r in store.list().collect()] == ["daily_B"]
