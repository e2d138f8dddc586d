"""One key holding a third of all rows: results stay whole and the plans
reduce the hot key before the shuffle."""

from pyspark.sql import functions as F

from tidemark.operators.cells import cell_versions, latest_cells
from tidemark.operators.counters import merge_increments
from tidemark.operators.offsets import offset_ranges
from tidemark.operators.paging import paginate

N = 30_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark):
    # a third of the rows on key "hot", the rest spread over 1000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%04d", F.col("id") % 1000))
        .alias("rowkey"),
        F.col("id").alias("seq"),
        F.lit(1).cast("bigint").alias("click_count"))


def test_hot_counter_key(spark):
    df = _skewed(spark)
    merged = merge_increments(df)
    assert "partial_sum" in _plan(merged)
    got = dict(merged.collect())
    assert got["hot"] == N // 3 and sum(got.values()) == N


def test_hot_cell_versions(spark):
    cells = _skewed(spark).select("rowkey", F.lit("info").alias("cf"), F.lit("q").alias("qualifier"),
                                  (F.col("seq") % 97).alias("ts"), "seq", F.lit(b"v").alias("value"))
    latest = latest_cells(cells)
    plan = _plan(latest)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    hot = latest.filter("rowkey = 'hot'").collect()
    assert len(hot) == 1 and (hot[0].ts, hot[0].seq) == (96, max(i for i in range(0, N, 3) if i % 97 == 96))
    top3 = cell_versions(cells, 3).filter("rowkey = 'hot'").collect()
    assert sorted(r.version for r in top3) == [1, 2, 3]
    assert cell_versions(cells, 2 ** 31 - 1).count() == N


def test_hot_topic_partition_ranges(spark):
    rec = spark.range(N).select(F.lit("t").alias("topic"),
                                F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7 + 1).cast("int")
                                .alias("partition"),
                                F.col("id").alias("offset"))
    r = {x.partition: x for x in offset_ranges(rec).collect()}
    assert r[0].record_count == N // 3 and r[0].from_offset == 0 and r[0].until_offset == N - 2


def test_paginate_splits_hot_key(spark):
    df = _skewed(spark).select("rowkey", "seq")
    paged = paginate(df, 100, partitions=8, tiebreak=["seq"])
    # the hot key is spread over several range partitions, not one task
    parts = paged.filter("rowkey = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 2
    assert paged.count() == N
    assert paged.agg(F.max("row_num")).first()[0] == N
    assert paged.select("row_num").distinct().count() == N


def test_sorted_write_spreads_hot_row(spark, tmp_root):
    from tidemark.sources.cells import read_cells, write_cells
    cells = _skewed(spark).select("rowkey", F.lit("info").alias("cf"),
                                  F.format_string("q%d", F.col("seq") % 50).alias("qualifier"),
                                  F.col("seq").alias("ts"), "seq", F.lit(b"v").alias("value"))
    write_cells(cells, f"{tmp_root}/cells", files=8)
    back = read_cells(spark, f"{tmp_root}/cells")
    files = back.filter("rowkey = 'hot'").select(F.input_file_name()).distinct().count()
    assert files >= 2
    assert back.count() == N
