"""Counters as the engine's own state (AGG-3, SNK-3): a streaming aggregation
in update mode, whose changed rows are upserted by batch.

State lives in the RocksDB provider, so an executor holds more keys than fit
its heap. Each trigger emits only the keys it changed, with their new totals;
they replace the batch's partition of the table, and a key's newest total
counts, so a replayed batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import exists

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOTALS = "rowkey string, click_count bigint, batch_id bigint"


class StateCounters:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _upsert(self, changed: DataFrame, batch_id: int) -> None:
        (changed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{self.path}/totals"))

    def start(self, keys: DataFrame, **trigger) -> StreamingQuery:
        """``keys``: a stream with a ``rowkey`` column, one row per click."""
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        return (keys.groupBy("rowkey").agg(F.count(F.lit(1)).alias("click_count"))
                .writeStream.outputMode("update").foreachBatch(self._upsert)
                .option("checkpointLocation", f"{self.path}/checkpoint")
                .trigger(**(trigger or {"availableNow": True})).start())

    def read(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/totals"):
            return self.spark.createDataFrame([], "rowkey string, click_count bigint")
        totals = self.spark.read.schema(TOTALS).parquet(f"{self.path}/totals")
        return totals.groupBy("rowkey").agg(F.max_by("click_count", "batch_id").alias("click_count"))
