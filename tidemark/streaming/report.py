"""The range report of a running query (OFF-11), from its progress events."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.session import exists

REPORT = ("query_run string, batch_id bigint, at string, source string, start_offset string, end_offset string, "
          "input_rows bigint")


class RangeReport(StreamingQueryListener):
    """One row per trigger and source: where it began and ended and how many
    records it read. Rows are appended to the table at ``path`` every ``every``
    triggers and when a query ends. Register with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 500):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows += [(str(p.runId), p.batchId, p.timestamp, s.description, s.startOffset, s.endOffset, s.numInputRows)
                      for s in p.sources if s.numInputRows]
        if len(self.rows) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self.ended.set()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return (self.spark.read.schema(REPORT).parquet(self.path) if exists(self.spark, self.path)
                else self.spark.createDataFrame([], REPORT))
