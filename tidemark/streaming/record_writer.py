"""Per-partition record sinks of a running query (SNK-9).

``writeStream.foreach`` gives every task of every epoch an ``open``, its
records and a ``close`` that sees the error. ``EpochFiles`` makes that a sink
that handles each (partition, epoch) once: it writes aside, publishes by one
rename when ``close`` sees no error, and ``open`` returns False where the epoch
is published already, so a replayed epoch only does what was left undone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import exists, local_path, read_small, replace_file


def as_json(row: Row) -> str:
    return json.dumps(row.asDict(recursive=True), default=str)


class EpochFiles:
    """A writer for ``foreach``. ``process`` turns a record into a line (None:
    nothing to keep); it is the hook for the user's own work, with ``setup``
    making a resource for the partition and ``teardown(resource, error)``
    closing it. Files go through the file system of ``path`` as pyarrow knows
    it (``file``, ``hdfs``, ``s3`` and others); executors must all reach it."""

    def __init__(self, path: str, process: Callable[..., str | None] = as_json,
                 setup: Callable[[int, int], object] | None = None,
                 teardown: Callable[[object, Exception | None], None] | None = None):
        self.path, self.process_record, self.setup, self.teardown = path, process, setup, teardown

    def _files(self):
        from pyarrow import fs
        if "://" in self.path and not self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), local_path(self.path).replace("//", "/")

    def open(self, partition_id: int, epoch_id: int) -> bool:
        from pyarrow.fs import FileType
        self.out, self.resource = None, None
        self.fs, root = self._files()
        self.failed = f"{root}/_failed"
        self.final = f"{root}/epoch={epoch_id}/part-{partition_id:05d}.json"
        if self.fs.get_file_info(self.final).type != FileType.NotFound:
            return False
        self.aside = f"{root}/_open/{epoch_id}-{partition_id}-{uuid.uuid4().hex}"
        for folder in (f"{root}/_open", f"{root}/epoch={epoch_id}"):
            self.fs.create_dir(folder, recursive=True)
        if self.setup:
            self.resource = self.setup(partition_id, epoch_id)
        self.out = self.fs.open_output_stream(self.aside)
        return True

    def process(self, row: Row) -> None:
        line = self.process_record(self.resource, row) if self.setup else self.process_record(row)
        if line is not None:
            self.out.write(line.encode() + b"\n")

    def close(self, error: Exception | None) -> None:
        if self.out is None:  # published before, or the set-up failed
            return
        self.out.close()
        if error is None:
            self.fs.move(self.aside, self.final)
        else:
            self.fs.delete_file(self.aside)
            self.fs.create_dir(self.failed, recursive=True)
            with self.fs.open_output_stream(f"{self.failed}/{uuid.uuid4().hex}.json") as out:
                out.write(json.dumps({"part": self.final, "error": f"{type(error).__name__}: {error}"}).encode() + b"\n")
        if self.teardown:
            self.teardown(self.resource, error)


def write_records(stream: DataFrame, writer: EpochFiles, checkpoint: str, by: tuple[str, ...] = ("topic", "partition"),
                  partitions: int | None = None, **trigger) -> StreamingQuery:
    """Start a query that hands the stream's records to ``writer``. Records
    are dealt by ``by``, so that a replayed epoch has the same records in the
    same partition; the number of partitions is the session's at the first
    start, or ``partitions``, and kept for the sink's life."""
    spark, place = stream.sparkSession, f"{writer.path}/_partitions"
    if exists(spark, place):
        partitions = int(read_small(spark, place))
    else:
        partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        replace_file(spark, place, f"{place}.{uuid.uuid4().hex}", str(partitions))
    return (stream.repartition(partitions, *by).writeStream.foreach(writer)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
