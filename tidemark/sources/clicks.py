"""Click log (D8) derived from ``events``: one click per event.

ip comes from the user, ``category_id`` is the ``k`` field of ``props``,
``refer`` (the search source) is the event type, and errors are status 500."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.common import wall_time
from tidemark.sources.tables import read_table


def click_log(spark: SparkSession, sf_dir: str, with_ts: bool = True) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return clicks_from_events(ev, with_ts)


def clicks_from_events(ev: DataFrame, with_ts: bool = True, ts_col: str = "ts",
                       props_col: str = "props") -> DataFrame:
    uid = F.col("user_id")
    cols = [
        F.concat_ws(".", F.lit("10"), F.pmod(F.shiftright(uid, 16), F.lit(256)).cast("string"),
                    F.pmod(F.shiftright(uid, 8), F.lit(256)).cast("string"),
                    F.pmod(uid, F.lit(256)).cast("string")).alias("ip"),
        wall_time(ts_col).alias("time"),
        F.get_json_object(F.col(props_col), "$.k").cast("int").alias("category_id"),
        F.col("event_type").alias("refer"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
    ]
    if with_ts:
        cols.append(F.col(ts_col).alias("ts"))
    return ev.select(*cols)
