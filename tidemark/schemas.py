"""Explicit schemas of the data model (FIXTURES.md)."""

from pyspark.sql import types as T

TOPIC_RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

CLICK_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("refer", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
])

COUNTER = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("click_count", T.LongType()),
])

COUNTER_DELTA = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("delta", T.LongType()),
])

OFFSET_LOG = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("from_offset", T.LongType()),
    T.StructField("until_offset", T.LongType()),
    T.StructField("record_count", T.LongType()),
])

START_OFFSETS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

CELLS = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("cf", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("value", T.BinaryType()),
])

PAGE = T.StructType([
    T.StructField("page_index", T.IntegerType()),
    T.StructField("start_key", T.StringType()),
    T.StructField("end_key", T.StringType()),
    T.StructField("first_row", T.LongType()),
    T.StructField("prev_page", T.IntegerType()),
    T.StructField("next_page", T.IntegerType()),
    T.StructField("has_next", T.BooleanType()),
    T.StructField("total", T.LongType()),
])

OFFSET_LOG_STORED = T.StructType(OFFSET_LOG.fields + [
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

CELLS_STORED = T.StructType(CELLS.fields + [T.StructField("op", T.IntegerType())])
