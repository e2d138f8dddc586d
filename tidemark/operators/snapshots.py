"""Named snapshots (SNP-1..4).

Two kinds, one registry:

* **table snapshots** of a :class:`~tidemark.operators.cells.CellTable` or
  :class:`~tidemark.operators.cells.BucketedCellTable`: nothing is copied.
  Those tables never rewrite a file (every write is a new operation), so a
  snapshot only records the table and its newest operation id, and reading
  it is the table *as of* that operation - the same zero-copy idea as a
  snapshot that references existing store files;
* **copies** of any DataFrame under ``<root>/copies/<copy_id>/``.

``<root>/registry/`` is an append-only list of (snapshot_name, copy_id,
action, at_ms, table_path, table_kind, buckets, as_of_op), one row per take
or drop; the live list is the names whose newest action is a take. The
registry has one row per snapshot operation, so reading it to the driver is
bounded; the data itself never leaves the executors.

A name is claimed by a file before it is taken, so of two takers one is
refused. A table snapshot pins its operation at the table (the pin's id is its
``copy_id``). Dropping only records the drop; ``collect_garbage`` frees what no
live name refers to, once that has been so for a grace time."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import create_file, delete_path, exists, list_dirs, modified_ms

REGISTRY_SCHEMA = ("snapshot_name string, copy_id string, action string, at_ms bigint, "
                   "table_path string, table_kind string, buckets int, as_of_op int")


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _registry(self) -> DataFrame:
        p = f"{self.root}/registry"
        if not exists(self.spark, p):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(p)

    def _now(self) -> int:
        """Strictly after every recorded action, so the newest action of a
        name always wins even within one millisecond."""
        last = self._registry().agg(F.max("at_ms")).first()[0]
        now = int(time.time() * 1000)
        return now if last is None or now > last else last + 1

    def _record(self, rows: list[tuple]) -> None:
        full = [tuple(r) + (None,) * (8 - len(r)) for r in rows]
        self.spark.createDataFrame(full, REGISTRY_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/registry")

    def _live_df(self, name: str | None = None) -> DataFrame:
        """Live snapshots; with a name only its own actions are read."""
        w = Window.partitionBy("snapshot_name").orderBy(F.col("at_ms").desc(), F.col("action").asc())
        r = self._registry()
        if name is not None:
            r = r.filter(F.col("snapshot_name") == F.lit(name))
        r = r.withColumn("_rn", F.row_number().over(w))
        return r.filter((F.col("_rn") == 1) & (F.col("action") == "take")).drop("_rn")

    def live(self) -> DataFrame:
        return self._live_df().select("snapshot_name", "copy_id")

    def _live_record(self, name: str):
        return self._live_df(name).first()

    def _claim_path(self, name: str) -> str:
        """One file a name and life of it: it ends with each drop."""
        drops = self._registry().filter((F.col("snapshot_name") == F.lit(name)) & (F.col("action") == "drop")).count()
        return f"{self.root}/names/{hashlib.md5(name.encode()).hexdigest()}.{drops}"

    @contextmanager
    def _claimed(self, name: str) -> Iterator[None]:
        """The name for one taker, given back when taking fails."""
        if not name or not name.strip():
            raise ValueError("snapshot name is blank")
        claim = self._claim_path(name)
        if self._live_record(name) is not None or not create_file(self.spark, claim):
            raise ValueError(f"snapshot {name!r} exists")
        try:
            yield
        except BaseException:
            delete_path(self.spark, claim)
            raise

    def release(self, name: str) -> None:
        """Give back a name whose taker is known to have died."""
        claim = self._claim_path(name)
        if self._live_record(name) is None:
            delete_path(self.spark, claim)

    def take(self, name: str, df: DataFrame) -> str:
        """SNP-1 for any DataFrame: a copy under ``name``; a live name, or one
        that is being taken, is refused."""
        with self._claimed(name):
            copy_id = uuid.uuid4().hex
            df.write.mode("overwrite").parquet(f"{self.root}/copies/{copy_id}")
            self._record([(name, copy_id, "take", self._now())])
        return copy_id

    def take_table(self, name: str, table) -> int:
        """SNP-1 for a cell table, without copying: records the table and its
        newest operation. Returns that operation id."""
        from tidemark.operators.cells import BucketedCellTable
        with self._claimed(name):
            op = table.current_op()
            if isinstance(table, BucketedCellTable):  # nothing of it is ever removed
                row = (name, None, "take", self._now(), table.path, "bucketed", table.buckets, op)
            else:
                row = (name, table.pin(op), "take", self._now(), table.path, "folders", None, op)
            self._record([row])
        return op

    def read(self, name: str) -> DataFrame:
        r = self._live_record(name)
        if r is None:
            raise KeyError(name)
        if r["table_path"] is not None:
            from tidemark.operators.cells import BucketedCellTable, CellTable
            t = (BucketedCellTable(self.spark, r["table_path"], r["buckets"]) if r["table_kind"] == "bucketed"
                 else CellTable(self.spark, r["table_path"]))
            return t.scan(as_of=r["as_of_op"])
        return self.spark.read.parquet(f"{self.root}/copies/{r['copy_id']}")

    def list(self, pattern: str | None = None) -> DataFrame:
        """SNP-2: live snapshots whose whole name matches ``pattern``; a
        blank pattern lists all."""
        live = self.live()
        if pattern and pattern.strip():
            live = live.filter(F.col("snapshot_name").rlike(f"^(?:{pattern})$"))
        return live

    def drop_matching(self, pattern: str) -> list[str]:
        """SNP-3: drop every live snapshot whose name matches; blank refused."""
        if not pattern or not pattern.strip():
            raise ValueError("snapshot name pattern is blank")
        names = [r["snapshot_name"] for r in self.list(pattern).collect()]  # the names to drop
        if names:
            now = self._now()
            self._record([(n, None, "drop", now) for n in names])
        return names

    def drop(self, name: str) -> bool:
        """SNP-4: drop one snapshot by exact name; blank refused."""
        if not name or not name.strip():
            raise ValueError("snapshot name is blank")
        if self._live_record(name) is None:
            return False
        self._record([(name, None, "drop", self._now())])
        return True

    def collect_garbage(self, grace_s: float = 86_400) -> list[str]:
        """Free what no live snapshot refers to and return the folders removed:
        copies, and in the cell tables that were snapshotted the operations and
        bases that neither a pin nor the table itself needs. A copy or pin goes
        ``grace_s`` after its name was dropped, an unrecorded copy ``grace_s``
        after its last write (a taker that died; so the time must be longer than
        any copy takes to write)."""
        from tidemark.operators.cells import CellTable
        before = int((time.time() - grace_s) * 1000)
        lives = Window.partitionBy("snapshot_name").orderBy("at_ms", F.desc("action"))
        takes = (self._registry().withColumn("ended", F.lead("at_ms").over(lives)).filter(F.col("action") == "take")
                 .select("copy_id", "table_path", "table_kind", "ended").collect())  # one row per snapshot taken
        dead = {r["copy_id"] for r in takes if r["ended"] is not None and r["ended"] <= before}
        known = {r["copy_id"] for r in takes}
        removed = []
        for copy in list_dirs(self.spark, f"{self.root}/copies"):
            folder = f"{self.root}/copies/{copy}"
            if copy in dead or copy not in known and modified_ms(self.spark, folder) <= before:
                delete_path(self.spark, folder)
                removed.append(folder)
        tables = {r["table_path"] for r in takes if r["table_kind"] == "folders"}
        for r in takes:
            if r["table_kind"] == "folders" and r["copy_id"] in dead:
                CellTable(self.spark, r["table_path"]).unpin(r["copy_id"])
        for path in sorted(tables):
            if any(r["table_path"] == path and r["copy_id"] is None and (r["ended"] is None or r["ended"] > before)
                   for r in takes):
                continue  # a live snapshot from before there were pins
            removed += [f"{path}/{folder}" for folder in CellTable(self.spark, path).collect_garbage(grace_s)]
        return removed
