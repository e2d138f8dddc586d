import pytest
from pyspark.sql import functions as F

from tidemark.functions.codecs import from_utf8
from tidemark.operators.cells import (MAX_VERSIONS, CellTable, cell_versions, delete_rows, first_row,
                                      filter_scan, format_cells, get_row, get_rows, latest_cells, make_put,
                                      range_scan)


def _cells(spark, rows):
    return make_put(spark, rows, ts=1000)


def test_last_write_wins(spark):
    a = make_put(spark, [("r1", "info", "q", "old")], ts=1000, seq_start=0)
    b = make_put(spark, [("r1", "info", "q", "new")], ts=1000, seq_start=1)
    c = make_put(spark, [("r1", "info", "q", "older-ts")], ts=999, seq_start=5)
    got = latest_cells(a.unionByName(b).unionByName(c)).select(from_utf8("value")).first()[0]
    assert got == "new"


def test_multi_get_keeps_order_duplicates_and_missing(spark):
    cells = _cells(spark, [("a", "info", "x", "1"), ("b", "info", "x", "2")])
    rows = get_rows(cells, ["b", "missing", "a", "b"]).select("pos", "rowkey", from_utf8("value").alias("v")) \
        .collect()
    assert [(r.pos, r.rowkey, r.v) for r in rows] == [(0, "b", "2"), (1, "missing", None), (2, "a", "1"),
                                                      (3, "b", "2")]
    assert get_rows(cells, []).count() == 0


def test_multi_get_null_key_raises(spark):
    cells = _cells(spark, [("a", "info", "x", "1")])
    with pytest.raises(ValueError):
        get_rows(cells, ["b", None])


def test_get_row_absent_is_empty(spark):
    cells = _cells(spark, [("a", "info", "x", "1")])
    assert get_row(cells, "zz").count() == 0
    assert get_row(cells, "a").count() == 1


def test_range_scan(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1, 6)], "rowkey string")
    assert [r[0] for r in range_scan(df, "2", "4").orderBy("rowkey").collect()] == ["2", "3"]
    assert [r[0] for r in range_scan(df, "4").orderBy("rowkey").collect()] == ["4", "5"]


def test_first_row_and_filter_scan(spark):
    df = spark.createDataFrame([("b", 5), ("a", 1), ("c", 9)], "rowkey string, v int")
    assert first_row(df, F.col("v") >= 5).first().rowkey == "b"
    assert first_row(df, F.col("v") > 100).count() == 0
    preds = [F.col("v") > 1, F.col("rowkey") != "c"]
    assert [r.rowkey for r in filter_scan(df, *preds).collect()] == ["b"]
    assert len(preds) == 2  # predicates are not mutated


def test_versions(spark):
    cells = make_put(spark, [("r", "info", "q", f"v{i}") for i in range(5)], ts=1000)
    cells = cells.withColumn("ts", F.col("ts") + F.col("seq"))
    assert [r.v for r in cell_versions(cells, 0).select(from_utf8("value").alias("v")).collect()] == ["v4"]
    assert cell_versions(cells, 3).count() == 3
    assert cell_versions(cells, MAX_VERSIONS).count() == 5


def test_delete_rows(spark):
    cells = _cells(spark, [("a", "info", "x", "1"), ("b", "info", "x", "2")])
    assert delete_rows(cells, ["nope"]).count() == 2
    assert delete_rows(cells, []).count() == 2
    assert [r.rowkey for r in delete_rows(cells, ["a", "nope"]).collect()] == ["b"]


def test_format_cells(spark):
    cells = _cells(spark, [("a", "info", "x", "100")])
    assert format_cells(cells).first()["line"] == "info:x=100 @1000"


def test_cell_table_put_delete_put(spark, tmp_root):
    t = CellTable(spark, tmp_root)
    t.put(make_put(spark, [("a", "info", "x", "1"), ("b", "info", "x", "2")], ts=1000))
    t.put(make_put(spark, [("a", "info", "x", "3")], ts=2000))
    assert t.last_put_ms is not None and t.last_put_ms >= 0
    assert {r.rowkey: r.v for r in t.scan().select("rowkey", from_utf8("value").alias("v")).collect()} == \
        {"a": "3", "b": "2"}
    t.delete(["a", "nope"])
    assert [r.rowkey for r in t.scan().collect()] == ["b"]
    t.put(make_put(spark, [("a", "info", "y", "9")], ts=500))
    got = {(r.rowkey, r.qualifier) for r in t.scan().collect()}
    assert got == {("b", "x"), ("a", "y")}
    # the sample one-cell put: a counter-like value stored as text
    t.put_one("20171122_1", "info", "cagegory_click_count", "100")
    v = get_row(t.scan(), "20171122_1").select(from_utf8("value").alias("v")).first().v
    assert v == "100"


def test_key_list_is_a_join_below_the_keys_span(spark):
    cells = _cells(spark, [(f"k{i}", "info", "x", str(i)) for i in range(10)])
    keys = ["k1", "zz", "k3", "k5", "k1"]
    rows = get_rows(cells, keys).select("pos", "rowkey", from_utf8("value").alias("v")).collect()
    assert [(r.pos, r.rowkey, r.v) for r in rows] == [(0, "k1", "1"), (1, "zz", None), (2, "k3", "3"),
                                                      (3, "k5", "5"), (4, "k1", "1")]
    plan = get_rows(cells, keys)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and ">= k1" in plan and "<= zz" in plan


def test_bucketed_cell_table_no_shuffle(spark, tmp_root):
    from tidemark.operators.cells import BucketedCellTable
    t = BucketedCellTable(spark, tmp_root, buckets=4)
    t.put(make_put(spark, [("a", "info", "x", "1"), ("b", "info", "x", "2"), ("c", "info", "y", "5")], ts=1000))
    t.put(make_put(spark, [("a", "info", "x", "3")], ts=2000))
    t.delete(["c", "nope"])
    t.put(make_put(spark, [("c", "info", "z", "9")], ts=10))
    got = {(r.rowkey, r.qualifier, r.v) for r in t.scan().select("rowkey", "qualifier",
                                                                  from_utf8("value").alias("v")).collect()}
    assert got == {("a", "x", "3"), ("b", "x", "2"), ("c", "z", "9")}
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.scan(use_buckets=True)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        lookup = get_row(t.scan(use_buckets=True), "a")._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 4" in lookup
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    # reopening the same folder (e.g. a new session) sees the same table
    t2 = BucketedCellTable(spark, tmp_root, buckets=4)
    assert t2.scan().count() == 3
    # the same files read without the bucket spec give the same table
    plain = t2.scan()
    assert "WindowGroupLimit" in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, plain.select("rowkey", "qualifier").collect())) == \
        sorted(map(tuple, t2.scan(use_buckets=True).select("rowkey", "qualifier").collect()))


def test_first_cell_row(spark):
    from tidemark.operators.cells import first_cell_row
    cells = _cells(spark, [("b", "info", "x", "1"), ("b", "info", "y", "2"), ("c", "info", "x", "3"),
                           ("a", "info", "z", "4")])
    got = first_cell_row(cells, F.col("qualifier") != "z")
    assert sorted((r.rowkey, r.qualifier) for r in got.collect()) == [("b", "x"), ("b", "y")]
    assert first_cell_row(cells, F.col("qualifier") == "nope").count() == 0
    assert [r.rowkey for r in first_cell_row(cells).collect()] == ["a"]


def test_cell_table_compaction(spark, tmp_root):
    from tidemark.operators.snapshots import SnapshotStore
    t = CellTable(spark, f"{tmp_root}/t")
    snaps = SnapshotStore(spark, f"{tmp_root}/s")
    for i in range(4):
        t.put(make_put(spark, [("a", "info", "x", f"a{i}"), (f"r{i}", "info", "x", str(i))], ts=1000 + i))
    t.delete(["r1"])
    snaps.take_table("before", t)
    view = lambda df: sorted((r.rowkey, r.v) for r in df.select("rowkey", from_utf8("value").alias("v")).collect())
    before = view(t.scan())
    assert t.compact(keep_versions=2) == 4
    assert view(t.scan()) == before
    assert t.versions(5).filter("rowkey = 'a'").count() == 2  # versions beyond the kept ones are folded away
    t.put(make_put(spark, [("a", "info", "x", "new")], ts=5000))
    t.delete(["r2"])
    after = view(t.scan())
    assert ("a", "new") in after and not any(k == "r2" for k, _ in after)
    assert view(snaps.read("before")) == before
    # reads as of an operation older than the base use the op folders
    assert ("a", "a1") in view(t.scan(as_of=1)) and ("r1", "1") in view(t.scan(as_of=1))
    plan = t.scan()._jdf.queryExecution().optimizedPlan().toString()
    assert "base/v=4" in plan or "v=4" in str(t.raw().inputFiles())


def test_compaction_keeps_every_version(spark, tmp_root):
    from tidemark.operators.cells import MAX_VERSIONS
    t = CellTable(spark, tmp_root)
    for i in range(3):
        op = t.put(make_put(spark, [("a", "info", "x", str(i))], ts=1000 + i))
    t.compact()
    assert t.versions(3).count() == t.versions(MAX_VERSIONS).count() == t.versions(3, as_of=op).count() == 3
    t.compact(keep_versions=1)
    assert t.versions(3, as_of=op).count() == 3  # a reader of that operation sees what was there


def test_stored_lookups(spark, tmp_root):
    t = CellTable(spark, tmp_root)
    rows = [(f"r{i:04d}", "info", q, f"{q}{i}") for i in range(300) for q in ("x", "y")]
    t.put(make_put(spark, rows, ts=1000))
    t.put(make_put(spark, [("r0002", "info", "x", "later")], ts=2000))
    t.delete(["r0001"])
    text = lambda df: sorted((r.rowkey, r.qualifier, r.v) for r in
                             df.select("rowkey", "qualifier", from_utf8("value").alias("v")).collect())
    assert text(t.get("r0002")) == [("r0002", "x", "later"), ("r0002", "y", "y2")]
    assert text(t.get("r0001")) == text(t.get("nope")) == []
    assert [(r.pos, r.rowkey, r.qualifier) for r in t.get_many(["r0299", "nope", "r0001", "r0002"]).collect()] == [
        (0, "r0299", "x"), (0, "r0299", "y"), (1, "nope", None), (2, "r0001", None), (3, "r0002", "x"),
        (3, "r0002", "y")]
    page = t.page(2, after="r0000", predicates=(F.col("qualifier") == "x",), max_versions=5)
    assert sorted((r.rowkey, r.version) for r in page.collect()) == [("r0002", 1), ("r0002", 2), ("r0003", 1)]
    assert t.page(2, after="r0299").count() == 0
    # only the newest version counts, and keys are tried a few at a time
    assert text(t.first(from_utf8("value").isin("x2", "x200"), step=3)) == [("r0200", "x", "x200")]
    assert t.first(F.lit(False)).count() == 0
    for df in (t.get("r0002"), t.page(3, after="r0100")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(rowkey), " in plan


def test_operation_ids_are_claimed(spark, tmp_root, monkeypatch):
    """Two writers that saw the same listing do not take one id."""
    a, b = CellTable(spark, tmp_root), CellTable(spark, tmp_root)
    monkeypatch.setattr(a, "_next_op", lambda: 0)
    monkeypatch.setattr(b, "_next_op", lambda: 0)
    assert [x.put(make_put(spark, [(k, "info", "x", k)])) for x, k in ((a, "p"), (b, "q"))] == [0, 1]
    assert CellTable(spark, tmp_root).scan().count() == 2
