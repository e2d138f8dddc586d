"""The sorted key/cell table (D11) in long form:
``rowkey, cf, qualifier, ts, seq, value`` with one row per written cell
version. ``ts`` is the version time in epoch milliseconds, ``seq`` breaks ties
between writes with the same ``ts`` (later write wins).

:func:`cells_from_events` maps ``events`` onto it: row ``u<user_id>``, family
``info``, qualifier = event type, value = props bytes, one version per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codecs import to_utf8
from tidemark.sources.common import epoch_millis
from tidemark.sources.tables import read_table



def cells_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("rowkey"),
        F.lit("info").alias("cf"),
        F.col("event_type").alias("qualifier"),
        epoch_millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        to_utf8(F.col("props")).alias("value"),
    )


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: full scan of a stored cell table (parquet, written sorted by
    rowkey so row-group statistics prune key lookups and ranges)."""
    return spark.read.parquet(path)


def write_cells(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Store a cell table range-partitioned and sorted by key: key lookups
    and range scans then read only the row groups whose min/max cover the key."""
    order = ["rowkey", "cf", "qualifier", "seq"]  # a hot row still spans several files
    out = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    out.sortWithinPartitions("rowkey", "cf", "qualifier", F.col("ts").desc(), F.col("seq").desc()) \
        .write.mode(mode).parquet(path)
