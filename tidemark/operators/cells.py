"""Lookups and mutations on the key/cell table (LKP-1..7, SNK-5..8, SNK-10).

Reads follow the table's visibility rule: per (rowkey, cf, qualifier) the
newest version by (ts, seq) is the cell's value; older versions are kept for
version-limited scans. Key filters are plain predicates on ``rowkey`` so they
reach the parquet scan (PushedFilters + row-group pruning on a key-sorted
table)."""

from __future__ import annotations

import json
import time
import uuid
from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.codecs import from_utf8, to_utf8
from tidemark.functions.keys import region_of
from tidemark.session import (
    create_file,
    delete_path,
    exists,
    list_dirs,
    list_files,
    matches,
    modified_ms,
    read_small,
    replace_file,
)
from tidemark.sources.common import key_list_frame, restrict_to_keys

CELL_KEY = ["rowkey", "cf", "qualifier"]
MAX_VERSIONS = 2 ** 31 - 1  # "all versions"


def latest_cells(cells: DataFrame) -> DataFrame:
    """Visible table: newest (ts, seq) version per cell (SNK-6 last write
    wins). ``row_number() = 1`` per cell lets Spark insert a partial
    per-group limit before the shuffle, so a cell with millions of versions
    sends one row per map task."""
    w = Window.partitionBy(*CELL_KEY).orderBy(F.col("ts").desc(), F.col("seq").desc())
    return cells.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def cell_versions(cells: DataFrame, max_versions: int = 1) -> DataFrame:
    """LKP-7: ``<= 0`` -> newest only; ``MAX_VERSIONS`` -> all; n -> newest n
    per cell (with ``version`` = 1 for the newest).

    For a bounded n the ``row_number() <= n`` filter becomes a partial
    per-group limit before the shuffle, so a cell holding a third of the
    table sends at most n rows per map task. "All versions" needs no
    ranking at all and is a plain scan (no ``version`` column)."""
    w = Window.partitionBy(*CELL_KEY).orderBy(F.col("ts").desc(), F.col("seq").desc())
    if max_versions >= MAX_VERSIONS:
        return cells
    n = 1 if max_versions <= 0 else max_versions
    return cells.withColumn("version", F.row_number().over(w)).filter(F.col("version") <= n)


def put_cells(cells: DataFrame, puts: DataFrame) -> DataFrame:
    """SNK-5 / SNK-6: writes are appends; visibility is decided on read."""
    return cells.unionByName(puts.select(*schemas.CELLS.fieldNames()))


def make_put(spark: SparkSession, rows: list[tuple], ts: int | None = None, seq_start: int = 0) -> DataFrame:
    """Cells from (rowkey, cf, qualifier, value-string) tuples, value as UTF-8."""
    t = int(ts if ts is not None else time.time() * 1000)
    data = [(r[0], r[1], r[2], t, seq_start + i, r[3]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "rowkey string, cf string, qualifier string, ts bigint, seq bigint, v string")
    return df.select("rowkey", "cf", "qualifier", "ts", "seq", to_utf8("v").alias("value"))


def _key_frame(spark: SparkSession, keys: list[str] | DataFrame, key: str = "rowkey") -> DataFrame:
    if isinstance(keys, DataFrame):
        return keys.select(F.when(F.col(key).isNull(), F.raise_error(F.lit("null row key")))
                           .otherwise(F.col(key)).alias(key), *[c for c in keys.columns if c != key])
    return key_list_frame(spark, keys, key)


def delete_rows(cells: DataFrame, keys: list[str] | DataFrame) -> DataFrame:
    """SNK-7 / SNK-8: drop whole rows; absent keys are no-ops, an empty list
    changes nothing."""
    if isinstance(keys, list) and not keys:
        return cells
    kdf = _key_frame(cells.sparkSession, keys).select("rowkey")
    return cells.join(kdf, "rowkey", "left_anti")


def get_row(cells: DataFrame, rowkey: str) -> DataFrame:
    """LKP-1: visible cells of one row; empty when absent. The equality is
    pushed to the scan before the per-cell newest-version step."""
    return latest_cells(cells.filter(F.col("rowkey") == F.lit(rowkey)))


def get_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """LKP-2: rows for a key list in the list's order; a missing key yields
    one row with NULL cells, duplicates repeat. A NULL key raises; an empty
    list returns an empty frame."""
    spark = cells.sparkSession
    if not keys:
        return spark.createDataFrame([], "pos int, rowkey string, cf string, qualifier string, ts bigint, "
                                         "seq bigint, value binary")
    kdf = _key_frame(spark, keys)
    visible = latest_cells(restrict_to_keys(cells, keys))
    return kdf.join(visible, "rowkey", "left").orderBy("pos", "cf", "qualifier")


def first_row(df: DataFrame, predicate: Column | None = None, key: str = "rowkey") -> DataFrame:
    """LKP-4: first row in key order passing the predicate (empty if none).
    Planned as TakeOrderedAndProject: a per-task top-1, then one merge."""
    if predicate is not None:
        df = df.filter(predicate)
    return df.orderBy(key).limit(1)


def range_scan(df: DataFrame, start: str | None = None, stop: str | None = None, key: str = "rowkey") -> DataFrame:
    """LKP-5: keys in ``[start, stop)``; either bound optional."""
    if start is not None:
        df = df.filter(F.col(key) >= F.lit(start))
    if stop is not None:
        df = df.filter(F.col(key) < F.lit(stop))
    return df


def filter_scan(df: DataFrame, *predicates: Column) -> DataFrame:
    """LKP-6: the caller's predicates, all of them (the list is not mutated)."""
    for p in predicates:
        df = df.filter(p)
    return df


def scan_cells(cells: DataFrame, start: str | None = None, stop: str | None = None,
               predicates: tuple = (), max_versions: int = 0) -> DataFrame:
    """The paged scan's row selection in one call: key range ``[start,
    stop)``, the caller's predicates, then the version limit (<= 0 newest
    only). Range and predicates are applied to the versions before the limit,
    as server-side filters are."""
    return cell_versions(filter_scan(range_scan(cells, start, stop), *predicates), max_versions)


def page_rows(cells: DataFrame, size: int, after_key: str | None = None, start_key: str | None = None) -> DataFrame:
    """PAG-1 / PAG-2 for a table whose rows hold several cells: the page is
    the next ``size`` distinct row keys (a per-task top-n of keys), and the
    cells of exactly those rows are fetched with a semi-join against that
    page (at most ``size`` keys; AQE broadcasts it when it is small)."""
    keys = cells.select("rowkey")
    if start_key is not None:
        keys = keys.filter(F.col("rowkey") >= F.lit(start_key))
    if after_key is not None:
        keys = keys.filter(F.col("rowkey") > F.lit(after_key))
    page = keys.distinct().orderBy("rowkey").limit(size)
    return cells.join(page, "rowkey", "left_semi")


def first_cell_row(cells: DataFrame, predicate: Column | None = None) -> DataFrame:
    """LKP-4 on a cell table: the first row (in key order) with a visible
    cell passing the predicate, with all of that row's visible cells that
    pass it; empty when none does."""
    visible = latest_cells(cells)
    if predicate is not None:
        visible = visible.filter(predicate)
    return page_rows(visible, 1)


def format_cells(cells: DataFrame) -> DataFrame:
    """SNK-10: readable cell dump (family, qualifier, value as text, time)."""
    return cells.select("rowkey", "cf", "qualifier", from_utf8("value").alias("value_text"), "ts",
                        F.concat(F.col("cf"), F.lit(":"), F.col("qualifier"), F.lit("="),
                                 from_utf8("value"), F.lit(" @"), F.col("ts").cast("string")).alias("line"))


class CellTable:
    """A cell table on the shared folder. Every write is a new folder
    (``puts/op=<n>`` or ``deletes/op=<n>``): nothing is rewritten while it may
    be read. A delete hides the row's versions written by earlier operations
    (a later put shows again).

    ``split_keys`` make a new table pre-split: its cells lie in one folder per
    region (``region=<number of split keys up to the row key>``), so lookups by
    key and key ranges list and read their regions' folders only. They are
    stored with the table, which is opened without them later on. A region that
    holds a large share of all cells still is many files, written by many tasks.
    Row keys that all sort into one region should be salted (FN-5)."""

    def __init__(self, spark: SparkSession, path: str, split_keys: list[str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.split_keys = self._splits(split_keys)

    def _splits(self, asked: list[str] | None) -> list[str] | None:
        """The table's split keys; those asked for are stored if it is new."""
        path, asked = f"{self.path}/regions", asked and sorted(set(asked))
        if asked and not exists(self.spark, path):
            if list_files(self.spark, f"{self.path}/ops"):
                raise ValueError("the table has cells and no regions")
            replace_file(self.spark, path, f"{path}.{uuid.uuid4().hex}", json.dumps(asked))
        stored = json.loads(read_small(self.spark, path)) if exists(self.spark, path) else None
        if asked and asked != stored:
            raise ValueError("the table has other split keys")
        return stored

    def _regions_of(self, keys: list[str]) -> list[int] | None:
        """Regions that hold the keys; None (all) for a table without."""
        return sorted({bisect_right(self.split_keys, k) for k in keys}) if self.split_keys else None

    def _regions_between(self, start: str | None, stop: str | None) -> list[int] | None:
        """Regions that may hold keys of ``[start, stop)``."""
        if not self.split_keys:
            return None
        first = bisect_right(self.split_keys, start) if start is not None else 0
        last = bisect_left(self.split_keys, stop) if stop is not None else len(self.split_keys)
        return list(range(first, last + 1))

    def _next_op(self) -> int:
        ops = [int(d.split("=")[1]) for sub in ("puts", "deletes")
               for d in list_dirs(self.spark, f"{self.path}/{sub}") if d.startswith("op=")]
        return max([*ops, *map(int, list_files(self.spark, f"{self.path}/ops"))], default=-1) + 1

    def _claim_op(self) -> int:
        """A new operation id, claimed by a file that only one writer can
        create; a second writer that saw the same listing takes the next."""
        op = self._next_op()
        while not create_file(self.spark, f"{self.path}/ops/{op}"):
            op += 1
        return op

    def versions(self, max_versions: int, as_of: int | None = None) -> DataFrame:
        """LKP-7 on the stored table."""
        return cell_versions(self.raw(as_of).drop("op"), max_versions)

    last_put_ms: int | None = None  # elapsed time of the last put (the batch put's return value)

    def _finish(self, op: int) -> None:
        create_file(self.spark, f"{self.path}/finished/{op}")

    def abandon(self, op: int) -> None:
        """Give up an operation whose writer is known to be dead: what it left
        is removed and it no longer holds back compactions and snapshots."""
        for kind in ("puts", "deletes"):
            delete_path(self.spark, f"{self.path}/{kind}/op={op}")
        self._finish(op)

    def put(self, cells: DataFrame) -> int:
        t0 = time.time()
        op = self._claim_op()
        write_sorted(cells.select(*schemas.CELLS.fieldNames()), f"{self.path}/puts/op={op}", self.split_keys)
        self._finish(op)
        self.last_put_ms = int((time.time() - t0) * 1000)
        return op

    def put_one(self, rowkey: str, cf: str, qualifier: str, value: str, ts: int | None = None) -> int:
        """SNK-5: one cell, value stored as UTF-8 text."""
        return self.put(make_put(self.spark, [(rowkey, cf, qualifier, value)], ts=ts))

    def delete(self, keys: list[str] | DataFrame) -> int | None:
        if isinstance(keys, list) and not keys:
            return None
        op = self._claim_op()
        kdf = _key_frame(self.spark, keys).select("rowkey").distinct()
        kdf.write.parquet(f"{self.path}/deletes/op={op}")
        self._finish(op)
        return op

    def get(self, rowkey: str, as_of: int | None = None) -> DataFrame:
        """LKP-1 on the stored table: the key reaches the scan, which lists
        the key's region only."""
        return get_row(self.raw(as_of, self._regions_of([rowkey])).drop("op"), rowkey)

    def get_many(self, keys: list[str], as_of: int | None = None) -> DataFrame:
        """LKP-2 on the stored table: the keys reach the scan, in terms that
        statistics and the row keys' Bloom filters skip row groups by."""
        regions = self._regions_of([k for k in keys if k is not None])
        return get_rows(self.raw(as_of, regions).drop("op"), keys)

    def range(self, start: str | None = None, stop: str | None = None, as_of: int | None = None) -> DataFrame:
        """LKP-5 on the stored table: visible cells of rows in [start, stop)."""
        return latest_cells(range_scan(self.raw(as_of, self._regions_between(start, stop)).drop("op"), start, stop))

    def page(self, size: int, after: str | None = None, start: str | None = None, stop: str | None = None,
             predicates: tuple = (), max_versions: int = 0, as_of: int | None = None) -> DataFrame:
        """The paged scan in one call: the next ``size`` row keys after
        ``after`` within [start, stop) that have a stored version passing the
        predicates, with those versions up to the limit (<= 0 newest only). The
        page's keys come first, as a top-n of distinct keys without ranking
        any cell; being the smallest ones, they are a key range, which the
        scan for their cells is pruned to."""
        regions = self._regions_between(max((k for k in (start, after) if k is not None), default=None), stop)
        picked = filter_scan(range_scan(self.raw(as_of, regions).drop("op"), start, stop), *predicates)
        if after is not None:
            picked = picked.filter(F.col("rowkey") > F.lit(after))
        keys = [r[0] for r in picked.select("rowkey").distinct().orderBy("rowkey").limit(size).collect()]
        if not keys:
            return cell_versions(picked.limit(0), max_versions)
        return cell_versions(picked.filter(F.col("rowkey").between(keys[0], keys[-1])), max_versions)

    def first(self, predicate: Column | None = None, as_of: int | None = None, step: int = 64) -> DataFrame:
        """LKP-4 on the stored table: the first row with a visible cell that
        passes, with those cells. Row keys are tried in order, ``step`` at a
        time, so only the start of the table is ranked."""
        conds, after = (predicate,) if predicate is not None else (), None
        raw = self.raw(as_of).drop("op")
        while True:
            found = filter_scan(raw, *conds)
            if after is not None:
                found = found.filter(F.col("rowkey") > F.lit(after))
            keys = [r[0] for r in found.select("rowkey").distinct().orderBy("rowkey").limit(step).collect()]
            if not keys:
                return latest_cells(raw.limit(0))
            shown = filter_scan(latest_cells(raw.filter(F.col("rowkey").between(keys[0], keys[-1]))), *conds)
            first = shown.agg(F.min("rowkey")).first()[0]
            if first is not None:
                return filter_scan(get_row(raw, first), *conds)
            after = keys[-1]

    def current_op(self) -> int:
        """Id of the newest operation up to which all are finished (-1 for
        none). One that a slow writer has claimed but not finished holds it
        back: a compaction or snapshot as of a later one would miss its rows."""
        claimed = {int(n) for n in list_files(self.spark, f"{self.path}/ops")}
        running = claimed - {int(n) for n in list_files(self.spark, f"{self.path}/finished")}
        return min(running) - 1 if running else max(claimed, default=-1)

    def _base(self, as_of: int | None) -> tuple[int, str] | None:
        """(operation, folder) of the newest committed compaction usable for a
        read as of ``as_of``: an earlier read than now needs every version."""
        bases = sorted(((int(d[2:].split("-")[0]), d) for d in list_dirs(self.spark, f"{self.path}/base")
                        if d.startswith("v=")), reverse=True)
        for b, folder in bases:
            if ((as_of is None or b <= as_of and folder.endswith("-whole"))
                    and exists(self.spark, f"{self.path}/base/{folder}/_committed")):
                return b, folder
        return None

    def compact(self, keep_versions: int = MAX_VERSIONS) -> int | None:
        """Fold every operation so far into a base: the visible table with
        all versions - or the newest ``keep_versions`` per cell, for a table
        whose older versions may go - written key-sorted as ``base/v=<op>``
        and committed by a marker written last. Later reads start from the
        base plus newer operations; op folders stay. A base that kept only
        some versions does not serve reads as of its own operation, so
        snapshots answer as before."""
        op = self.current_op()
        if op < 0:
            return None
        kept = cell_versions(self.raw(as_of=op).drop("op"), keep_versions).drop("version")
        kind = "whole" if keep_versions >= MAX_VERSIONS else "newest"
        write_sorted(kept, f"{self.path}/base/v={op}-{kind}/cells", self.split_keys)
        self.spark.createDataFrame([(op,)], "op int").coalesce(1).write.mode("overwrite") \
            .parquet(f"{self.path}/base/v={op}-{kind}/_committed")
        return op

    def pin(self, op: int) -> str:
        """Keep the table as of ``op`` readable: garbage collection leaves what
        such a read needs until ``unpin`` of the returned id."""
        pin = f"{op}.{uuid.uuid4().hex}"
        create_file(self.spark, f"{self.path}/pins/{pin}")
        try:
            self._check_there(op, self._base(op))
        except LookupError:
            self.unpin(pin)
            raise
        return pin

    def unpin(self, pin: str) -> None:
        delete_path(self.spark, f"{self.path}/pins/{pin}")

    def _check_there(self, as_of: int, found: tuple[int, str] | None) -> None:
        """A read as of an operation that was not pinned when others up to it
        were collected would miss their rows."""
        base = found[0] if found else -1
        if any(base < int(op) <= as_of for op in list_files(self.spark, f"{self.path}/collected")):
            raise LookupError(f"the table as of operation {as_of} was collected")

    def collect_garbage(self, grace_s: float = 86_400) -> list[str]:
        """Remove what no read needs any more, and return the folders removed.

        Kept are the newest base with all versions that was committed
        ``grace_s`` ago or earlier (longer than any reader or snapshot taker
        lives), everything newer, and for each pinned operation the base below
        it and the operations between. Operations are marked as collected
        before their folders go, so that a read as of one is refused instead of
        answered short, and a run that died half way is taken up by the next."""
        before = (time.time() - grace_s) * 1000
        bases = {d: exists(self.spark, f"{self.path}/base/{d}/_committed")
                 for d in list_dirs(self.spark, f"{self.path}/base") if d.startswith("v=")}
        at = {d: int(d[2:].split("-")[0]) for d in bases}
        whole = [at[d] for d, committed in bases.items() if committed and d.endswith("-whole")]
        floor = max((at[d] for d, committed in bases.items() if committed and d.endswith("-whole")
                     and modified_ms(self.spark, f"{self.path}/base/{d}/_committed") <= before), default=None)
        if floor is None:
            return []
        # (base, operation]: what each pinned read below the floor needs
        needed = [(max((b for b in whole if b <= pin), default=-1), pin)
                  for pin in {int(p.split(".")[0]) for p in list_files(self.spark, f"{self.path}/pins")} if pin < floor]
        gone = [f"{kind}/{d}" for kind in ("puts", "deletes") for d in list_dirs(self.spark, f"{self.path}/{kind}")
                if d.startswith("op=") and (op := int(d[3:])) <= floor
                and not any(base < op <= pin for base, pin in needed)]
        used = {base for base, _ in needed}
        gone += [f"base/{d}" for d, committed in bases.items()
                 if at[d] < floor and not (committed and d.endswith("-whole") and at[d] in used)
                 and (committed or modified_ms(self.spark, f"{self.path}/base/{d}") <= before)]
        for folder in gone:
            if "/op=" in folder:
                create_file(self.spark, f"{self.path}/collected/{folder.split('=')[1]}")
        for folder in gone:
            delete_path(self.spark, f"{self.path}/{folder}")
        return gone

    def _read(self, folder: str, below: str, schema, regions: list[int] | None) -> DataFrame:
        """Cells under ``folder``; ``below`` leads from it to the region
        folders. With regions given only theirs are listed; one that no write
        has reached is empty."""
        if not self.split_keys:
            return self.spark.read.schema(schema).parquet(folder)
        paths = [folder] if regions is None else [p for r in regions if matches(
            self.spark, p := f"{folder}/{below}region={r}")]
        if not paths:
            return self.spark.createDataFrame([], schema)
        located = T.StructType([*schema.fields, T.StructField("region", T.IntegerType())])
        return self.spark.read.schema(located).option("basePath", folder).parquet(*paths).drop("region")

    def raw(self, as_of: int | None = None, regions: list[int] | None = None) -> DataFrame:
        """All stored versions still visible after deletes (with ``op``);
        ``as_of`` reads the table as it was after that operation (the op
        folders above it are pruned as partitions), ``regions`` the cells of
        some regions of a pre-split table."""
        empty = self.spark.createDataFrame([], schemas.CELLS_STORED)
        cells = (self._read(f"{self.path}/puts", "op=*/", schemas.CELLS_STORED, regions)
                 if exists(self.spark, f"{self.path}/puts") else empty)
        found = self._base(as_of)
        base = found and found[0]
        if as_of is not None:
            self._check_there(as_of, found)
        if found:
            # folded operations come from the base; only newer ones are read
            cells = cells.filter(F.col("op") > base).unionByName(
                self._read(f"{self.path}/base/{found[1]}/cells", "", schemas.CELLS, regions)
                .withColumn("op", F.lit(base)))
        if as_of is not None:
            cells = cells.filter(F.col("op") <= as_of)
        if not exists(self.spark, f"{self.path}/deletes"):
            return cells
        dels = self.spark.read.schema("rowkey string, op int").parquet(f"{self.path}/deletes")
        if base is not None:
            dels = dels.filter(F.col("op") > base)  # older deletes are applied in the base
        if as_of is not None:
            dels = dels.filter(F.col("op") <= as_of)
        dels = dels.groupBy("rowkey").agg(F.max("op").alias("_del_op"))
        return (cells.join(dels, "rowkey", "left")
                .filter(F.col("_del_op").isNull() | (F.col("op") > F.col("_del_op"))).drop("_del_op"))

    def scan(self, as_of: int | None = None) -> DataFrame:
        """SRC-6: full scan of the visible table (optionally as of an op)."""
        return latest_cells(self.raw(as_of).drop("op"))


class BucketedCellTable:
    """The cell table stored as two tables bucketed by ``rowkey`` into the
    same number of buckets (puts and deletes), registered in the session
    catalog over folders under ``path``.

    Both sides of the delete join and the per-cell newest-version window are
    then already hash-partitioned by ``rowkey``: visibility needs no shuffle
    at all, and a key lookup reads a single bucket. Writes are hashed into
    the table's buckets before the insert, so each task writes one file per
    bucket. Operation ids (ordering deletes against puts) come from an
    append-only op log of one folder per operation."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, name: str | None = None):
        import hashlib
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = int(buckets)
        base = name or "tidemark_cells_" + hashlib.md5(self.path.encode()).hexdigest()[:12]
        self.puts_table, self.deletes_table = f"{base}_puts", f"{base}_deletes"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.puts_table} (rowkey STRING, cf STRING, qualifier STRING, "
                  f"ts BIGINT, seq BIGINT, value BINARY, op INT) USING parquet CLUSTERED BY (rowkey) "
                  f"SORTED BY (rowkey) INTO {self.buckets} BUCKETS LOCATION '{self.path}/puts'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.deletes_table} (rowkey STRING, op INT) USING parquet "
                  f"CLUSTERED BY (rowkey) SORTED BY (rowkey) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}/deletes'")

    def _next_op(self) -> int:
        ops = [int(d.split("=")[1]) for d in list_dirs(self.spark, f"{self.path}/oplog") if d.startswith("op=")]
        return max(ops) + 1 if ops else 0

    def _log_op(self, op: int, kind: str) -> None:
        self.spark.createDataFrame([(op, kind, int(time.time() * 1000))], "op int, kind string, at_ms bigint") \
            .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/oplog/op={op}")

    def current_op(self) -> int:
        return self._next_op() - 1

    # The op id is logged before the data is written: a failed write leaves
    # an id without data (harmless), never data under an id reused later.
    last_put_ms: int | None = None

    def put(self, cells: DataFrame) -> int:
        t0 = time.time()
        op = self._next_op()
        self._log_op(op, "put")
        (cells.select(*schemas.CELLS.fieldNames()).withColumn("op", F.lit(op)).transform(self._by_bucket)
         .write.mode("append").insertInto(self.puts_table))
        self.last_put_ms = int((time.time() - t0) * 1000)
        return op

    def put_one(self, rowkey: str, cf: str, qualifier: str, value: str, ts: int | None = None) -> int:
        return self.put(make_put(self.spark, [(rowkey, cf, qualifier, value)], ts=ts))

    def delete(self, keys: list[str] | DataFrame) -> int | None:
        if isinstance(keys, list) and not keys:
            return None
        op = self._next_op()
        self._log_op(op, "delete")
        (_key_frame(self.spark, keys).select("rowkey").distinct().withColumn("op", F.lit(op)).transform(self._by_bucket)
         .write.mode("append").insertInto(self.deletes_table))
        return op

    def _by_bucket(self, rows: DataFrame) -> DataFrame:
        """Rows of a bucket go to the same writer; AQE splits a bucket that is
        too large for one (a row with a large share of all cells)."""
        return (rows.withColumn("_bucket", F.pmod(F.hash("rowkey"), F.lit(self.buckets)))
                .hint("rebalance", "_bucket").drop("_bucket"))

    def raw(self, as_of: int | None = None, use_buckets: bool = False) -> DataFrame:
        """Read plainly by default: the newest-version step gets its map-side
        partial limit and AQE can split skewed partitions. ``use_buckets=True``
        reads with the bucket spec and no shuffle, one task per bucket: for
        tables in which no row holds a large share of all cells."""
        if use_buckets:
            cells, dels = self.spark.table(self.puts_table), self.spark.table(self.deletes_table)
        else:
            cells = self.spark.read.schema(schemas.CELLS_STORED).parquet(f"{self.path}/puts")
            dels = self.spark.read.schema("rowkey string, op int").parquet(f"{self.path}/deletes") \
                if exists(self.spark, f"{self.path}/deletes") else \
                self.spark.createDataFrame([], "rowkey string, op int")
        if as_of is not None:
            cells, dels = cells.filter(F.col("op") <= as_of), dels.filter(F.col("op") <= as_of)
        dels = dels.groupBy("rowkey").agg(F.max("op").alias("_del_op"))
        return (cells.join(dels, "rowkey", "left")
                .filter(F.col("_del_op").isNull() | (F.col("op") > F.col("_del_op"))).drop("_del_op"))

    def scan(self, as_of: int | None = None, use_buckets: bool = False) -> DataFrame:
        return latest_cells(self.raw(as_of, use_buckets).drop("op"))


#: Parquet writes a Bloom filter of each row group's row keys, sized by what it holds.
BLOOM = {"parquet.bloom.filter.enabled#rowkey": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def write_sorted(cells: DataFrame, path: str, split_keys: list[str] | None = None) -> None:
    """Files range-partitioned and sorted by key, in a folder per region if
    there are split keys. The range bounds include the cell columns and
    ``seq``, so a row holding a large share of all cells spans several files
    instead of one task; key order across files is kept."""
    order = ["rowkey", "cf", "qualifier", F.col("ts").desc(), F.col("seq").desc()]
    out = cells.repartitionByRange("rowkey", "cf", "qualifier", "seq")
    if split_keys:  # regions ascend with the keys: this order serves both
        out = out.withColumn("region", region_of("rowkey", split_keys)).sortWithinPartitions("region", *order)
        out.write.mode("overwrite").options(**BLOOM).partitionBy("region").parquet(path)
    else:
        out.sortWithinPartitions(*order).write.mode("overwrite").options(**BLOOM).parquet(path)
