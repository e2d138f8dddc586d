"""Frames every registered query starts from, all derived from the driver's
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codecs import from_utf8
from tidemark.operators import counters as C
from tidemark.sources.cells import cells_from_events
from tidemark.sources.clicks import click_log
from tidemark.sources.topic import DEFAULT_BATCH_RECORDS, DEFAULT_PARTITIONS, topic_log

GROUP_ID = "clicks"
RUN_ID = "run0"
PAGE_SIZE = 100
RECORDS_PER_BATCH = DEFAULT_PARTITIONS * DEFAULT_BATCH_RECORDS


def topic(spark: SparkSession, sf: str) -> DataFrame:
    return topic_log(spark, sf)


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return click_log(spark, sf)


def counters(spark: SparkSession, sf: str) -> DataFrame:
    return C.clicks_per_day_category(clicks(spark, sf))


def search_counters(spark: SparkSession, sf: str) -> DataFrame:
    return C.clicks_per_day_search_category(clicks(spark, sf))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return cells_from_events(spark, sf)


def readable(cells_df: DataFrame, *extra: str) -> DataFrame:
    """Cells with the value as text (binary columns are not compared)."""
    return cells_df.select(*extra, "rowkey", "cf", "qualifier", "ts", "seq", from_utf8("value").alias("value_text"))


def offset_log(spark: SparkSession, sf: str) -> DataFrame:
    """The offset log a consumer of the whole topic writes: one row per
    (batch, partition), as OffsetLog.append stores it."""
    from tidemark.operators.offsets import offset_ranges
    return (offset_ranges(topic(spark, sf), by=["batch_id"])
            .select(F.lit(GROUP_ID).alias("group_id"), "topic", "partition", "from_offset", "until_offset",
                    "record_count", F.lit(RUN_ID).alias("run_id"), "batch_id"))


# ---- DuckDB side -----------------------------------------------------------

SQL_DAY = "strftime(ts, '%Y%m%d')"
SQL_CAT = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
SQL_COUNTERS = (f"SELECT concat_ws('_', {SQL_DAY}, CAST({SQL_CAT} AS VARCHAR)) AS rowkey, "
                "count(*) AS click_count FROM events GROUP BY 1")
SQL_SEARCH_COUNTERS = (f"SELECT concat_ws('_', {SQL_DAY}, event_type, CAST({SQL_CAT} AS VARCHAR)) AS rowkey, "
                       "count(*) AS click_count FROM events GROUP BY 1")
SQL_TOPIC = (f"SELECT 'events' AS topic, CAST(event_id % {DEFAULT_PARTITIONS} AS INTEGER) AS \"partition\", "
             f"event_id // {DEFAULT_PARTITIONS} AS \"offset\", ts AS \"timestamp\", "
             "CAST(user_id AS VARCHAR) AS \"key\", props AS \"value\", "
             f"event_id // {RECORDS_PER_BATCH} AS batch_id FROM events")
SQL_CELLS = ("SELECT 'u' || CAST(user_id AS VARCHAR) AS rowkey, 'info' AS cf, event_type AS qualifier, "
             "epoch_us(ts) // 1000 AS ts, event_id AS seq, props AS value_text FROM events")
SQL_LATEST_CELLS = ("SELECT rowkey, cf, qualifier, ts, seq, value_text FROM (SELECT *, row_number() OVER "
                    "(PARTITION BY rowkey, cf, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM cells_v) "
                    "WHERE rn = 1")
SQL_OFFSET_LOG = ("SELECT 'clicks' AS group_id, topic, \"partition\", min(\"offset\") AS from_offset, "
                  "max(\"offset\") + 1 AS until_offset, count(*) AS record_count, batch_id "
                  "FROM topic_v GROUP BY topic, \"partition\", batch_id")


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it names."""
    defs = {"counters_v": SQL_COUNTERS, "search_v": SQL_SEARCH_COUNTERS, "topic_v": SQL_TOPIC,
            "cells_v": SQL_CELLS, "log_v": SQL_OFFSET_LOG, "latest_v": SQL_LATEST_CELLS}
    order = ["counters_v", "search_v", "topic_v", "cells_v", "log_v", "latest_v"]
    need = set(names)
    if "log_v" in need:
        need.add("topic_v")
    if "latest_v" in need:
        need.add("cells_v")
    ctes = [f"{n} AS ({defs[n]})" for n in order if n in need]
    return ("WITH " + ", ".join(ctes) + " " + body) if ctes else body
