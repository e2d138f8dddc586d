"""Click counters (AGG-1..4, SNK-3, SNK-4, LKP-3).

A counter table is a keyed sum. Increments are never applied in place:
each micro-batch writes its own *delta* partition
``<store>/deltas/run_id=<r>/batch_id=<b>/`` with dynamic partition overwrite,
so replaying a batch replaces its delta instead of adding it twice; the
counter value is the sum of all deltas (plus a compacted base). Every
aggregation here is a partial hash aggregate before the shuffle, so a hot key
reaches the exchange as one row per map task, not as its raw clicks.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.keys import counter_key, day_of
from tidemark.operators.commits import CommitFile
from tidemark.session import create_file, delete_path, exists, list_dirs, modified_ms
from tidemark.sources.common import key_list_frame, restrict_to_keys

# Fixed values that must equal the original's: the counter cell's family and
# qualifier (both counter kinds share them).
COUNTER_CF = "info"
COUNTER_QUALIFIER = "click_count"


def clicks_per_day_category(clicks: DataFrame, ts_col: str = "ts") -> DataFrame:
    """AGG-3: ``day_category`` -> clicks."""
    return (clicks.groupBy(counter_key(day_of(ts_col), "category_id").alias("rowkey"))
            .agg(F.count(F.lit(1)).alias("click_count")))


def clicks_per_day_search_category(clicks: DataFrame, ts_col: str = "ts") -> DataFrame:
    """AGG-4: ``day_search_category`` -> clicks."""
    return (clicks.groupBy(counter_key(day_of(ts_col), "refer", "category_id").alias("rowkey"))
            .agg(F.count(F.lit(1)).alias("click_count")))


def merge_increments(increments: DataFrame, key: str = "rowkey", amount: str = "click_count",
                     out: str = "click_count") -> DataFrame:
    """AGG-1: repeated increments of a key add up; an absent key starts at 0."""
    return increments.groupBy(key).agg(F.sum(amount).cast("bigint").alias(out))


def lookup_counters(counters: DataFrame, keys: DataFrame | list[str], key: str = "rowkey",
                    value: str = "click_count") -> DataFrame:
    """LKP-3: value per asked key, 0 when absent.

    The counters are first cut to the asked keys by a semi-join (a Python
    list, with its order column ``pos``, also by the span of its keys, which
    reaches the scan), so the side joined back has at most one row per key.
    AQE broadcasts a side only when its runtime size allows it."""
    spark = counters.sparkSession
    if isinstance(keys, list):
        kdf = key_list_frame(spark, keys, key)
        found = restrict_to_keys(counters, keys, key).select(key, value)
    else:
        kdf = keys
        found = counters.join(keys.select(key).distinct(), key, "left_semi").select(key, value)
    return (kdf.join(found, on=key, how="left")
            .withColumn(value, F.coalesce(F.col(value), F.lit(0).cast("bigint"))))


DELTA = "rowkey string, delta bigint"
BOUND = "run_id string, commit_path string"


def new_run_id(prefix: str = "run") -> str:
    """Sortable by time and never equal for two callers."""
    return f"{prefix}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


class CounterStore:
    """Replay-safe counter table on a shared folder (SNK-3, SNK-4, LKP-3).

    ``add(batch_df, batch_id)`` writes the batch's pre-aggregated deltas to
    the partition of (run_id, batch_id) with dynamic overwrite; ``read()``
    sums deltas per key. ``compact()`` folds the deltas that are there into a
    new base version and records exactly which batches it folded, as ranges
    of batch ids per run: reads open only the folders of other batches, and a
    batch that arrives late counts whatever its id. Folders that a committed
    base has folded are removed by ``vacuum()`` after a retention time.

    A batch is counted once per (run_id, batch_id). A run that is *bound* to
    a group's commit file (``bind``) shares one commit with its offsets: a
    delta counts only once the file says that its run has finished the batch.
    If a process dies in between, the delta stays invisible; the same
    checkpoint replays the batch over it, and a new checkpoint, which starts
    from the file's positions, counts the records under its own run. So a
    record counts exactly once, across checkpoints too. Compaction folds
    visible batches only. Runs that are not bound (single increments,
    backfills) count as they are written."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.run_id = run_id or new_run_id()

    @property
    def deltas_path(self) -> str:
        return f"{self.path}/deltas"

    @property
    def bound_path(self) -> str:
        return f"{self.path}/bound"

    def bind(self, run_id: str, commits: CommitFile) -> None:
        """From now on this run's deltas count only as the commit file says.
        Recorded with the store, so that every reader goes by it."""
        if run_id not in self._bound():
            self.spark.createDataFrame([(run_id, commits.path)], BOUND).coalesce(1).write.mode("append") \
                .parquet(self.bound_path)

    def _bound(self) -> dict[str, str]:
        """Commit file of each bound run: one row per run."""
        if not exists(self.spark, self.bound_path):
            return {}
        return {r["run_id"]: r["commit_path"] for r in self.spark.read.schema(BOUND).parquet(self.bound_path).collect()}

    def _visible(self, batches: set[tuple[str, int]]) -> set[tuple[str, int]]:
        """The batches that count. The commit files are read after the deltas
        were listed: a batch that is finished has its delta there whole."""
        bound = self._bound()
        read = {path: CommitFile(self.spark, path).read() for path in set(bound.values())}
        finished = {run: read[path].finished.get(run, -1) if read[path] else -1 for run, path in bound.items()}
        return {(run, b) for run, b in batches if run not in bound or b <= finished[run]}

    def add(self, increments: DataFrame, batch_id: int, key: str = "rowkey",
            amount: str | None = "click_count") -> None:
        """Write one batch of increments. ``amount=None`` counts rows."""
        if amount is None:
            agg = increments.groupBy(key).agg(F.count(F.lit(1)).alias("delta"))
        else:
            agg = increments.groupBy(key).agg(F.sum(amount).cast("bigint").alias("delta"))
        (agg.withColumnRenamed(key, "rowkey")
         .withColumn("run_id", F.lit(self.run_id)).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .sortWithinPartitions("rowkey")  # key-sorted files: lookups skip row groups
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").parquet(self.deltas_path))

    def add_many(self, increments: DataFrame, batch_col: str = "batch_id", key: str = "rowkey",
                 amount: str | None = "click_count") -> None:
        """Write the deltas of many batches in one job (backfill / replay of
        a bounded log): one partition per batch, each replaced as a whole."""
        b = F.col(batch_col).cast("bigint").alias("batch_id")
        if amount is None:
            agg = increments.groupBy(b, F.col(key).alias("rowkey")).agg(F.count(F.lit(1)).alias("delta"))
        else:
            agg = increments.groupBy(b, F.col(key).alias("rowkey")).agg(
                F.sum(amount).cast("bigint").alias("delta"))
        (agg.withColumn("run_id", F.lit(self.run_id))
         .select("rowkey", "delta", "run_id", "batch_id")
         # AQE rebalance: rows of a batch go to the same writers where they
         # fit, an oversized batch is split over several, small ones merged
         .hint("rebalance", "run_id", "batch_id")
         .sortWithinPartitions("rowkey")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").parquet(self.deltas_path))

    def increment(self, rowkey: str, amount: int, batch_id: int | None = None) -> None:
        """SNK-4: one-key increment. Every call adds (it is a run of its own);
        with a ``batch_id`` of this store's run a repeated call is a replay."""
        one = self.spark.createDataFrame([(rowkey, int(amount))], "rowkey string, click_count bigint")
        if batch_id is None:
            CounterStore(self.spark, self.path, new_run_id("increment")).add(one, 0)
        else:
            self.add(one, batch_id)

    def _base_path(self) -> str | None:
        """Newest *committed* base version: a compaction that died half way
        has no commit marker and is ignored."""
        versions = sorted((int(d[2:]) for d in list_dirs(self.spark, f"{self.path}/base") if d.startswith("v=")),
                          reverse=True)
        for v in versions:
            if exists(self.spark, f"{self.path}/base/v={v}/_committed"):
                return f"{self.path}/base/v={v}"
        return None

    def _batches(self) -> set[tuple[str, int]]:
        """(run_id, batch_id) of every delta folder, from one listing."""
        return {(run[7:], int(batch[9:])) for run in list_dirs(self.spark, self.deltas_path)
                if run.startswith("run_id=") for batch in list_dirs(self.spark, f"{self.deltas_path}/{run}")
                if batch.startswith("batch_id=")}

    def _folded(self, base: str | None) -> dict[str, list[tuple[int, int]]]:
        """Ranges of batch ids per run that a base has folded: one row per
        run and gap in its batch ids."""
        out: dict[str, list[tuple[int, int]]] = {}
        if base:
            for r in self.spark.read.schema("run_id string, first bigint, last bigint").parquet(
                    f"{base}/_covered").collect():
                out.setdefault(r["run_id"], []).append((r["first"], r["last"]))
        return out

    def _open(self, batches: set[tuple[str, int]], folded: dict[str, list[tuple[int, int]]]) -> set[tuple[str, int]]:
        return {(run, b) for run, b in batches if not any(x <= b <= y for x, y in folded.get(run, ()))}

    def _sum(self, base: str | None, batches: set[tuple[str, int]]) -> DataFrame:
        parts = []
        if base:
            parts.append(self.spark.read.schema("rowkey string, click_count bigint").parquet(f"{base}/counters")
                         .withColumnRenamed("click_count", "delta"))
        if batches:
            parts.append(self.spark.read.schema(DELTA).parquet(
                *(f"{self.deltas_path}/run_id={run}/batch_id={b}" for run, b in sorted(batches))))
        if not parts:
            return self.spark.createDataFrame([], schemas.COUNTER)
        allp = parts[0]
        for p in parts[1:]:
            allp = allp.unionByName(p)
        return allp.groupBy("rowkey").agg(F.sum("delta").cast("bigint").alias("click_count"))

    def read(self) -> DataFrame:
        base = self._base_path()
        return self._sum(base, self._visible(self._open(self._batches(), self._folded(base))))

    def get(self, keys: list[str]) -> DataFrame:
        return lookup_counters(self.read(), keys)

    def compact(self) -> str:
        """Fold base + deltas into base version v+1 (written, then switched to
        by being the highest committed version; nothing is rewritten in
        place, so readers of the old version are never broken). One listing
        says what is folded and what is recorded as folded, so a batch that
        lands meanwhile stays outside and is read next time."""
        versions = [int(d[2:]) for d in list_dirs(self.spark, f"{self.path}/base") if d.startswith("v=")]
        nxt = max(versions) + 1 if versions else 0
        # one caller gets a version; each is whole in itself, the highest committed one is read
        while not create_file(self.spark, f"{self.path}/base/claims/{nxt}"):
            nxt += 1
        target = f"{self.path}/base/v={nxt}"
        base, batches = self._base_path(), self._batches()
        folded = self._folded(base)
        added = self._visible(self._open(batches, folded))
        self._sum(base, added).repartitionByRange("rowkey").sortWithinPartitions("rowkey") \
            .write.mode("overwrite").parquet(f"{target}/counters")
        # an increment's run is never written again: once its folder is gone it need not be remembered
        runs = {run for run, _ in batches}
        ranges = [(run, x, y) for run, some in folded.items() for x, y in some
                  if run in runs or not run.startswith("increment-")]
        rows = _joined_ranges(ranges + [(run, b, b) for run, b in added])
        self.spark.createDataFrame(rows, "run_id string, first bigint, last bigint").coalesce(1) \
            .write.mode("overwrite").parquet(f"{target}/_covered")
        # written last: only now does this version become the base
        self.spark.createDataFrame([(nxt,)], "v int").coalesce(1).write.mode("overwrite") \
            .parquet(f"{target}/_committed")
        return target

    def vacuum(self, older_than_s: float = 7 * 86_400) -> int:
        """Remove delta folders that the committed base has folded and that
        were last written ``older_than_s`` ago (longer than any reader or
        replay lives). Returns how many were removed."""
        batches, base = self._batches(), self._base_path()
        done = batches - self._open(batches, self._folded(base))
        before, removed = time.time() * 1000 - older_than_s * 1000, 0
        for run, b in done:
            folder = f"{self.deltas_path}/run_id={run}/batch_id={b}"
            if modified_ms(self.spark, folder) <= before:
                delete_path(self.spark, folder)
                removed += 1
        return removed


def _joined_ranges(rows: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Ranges per run with neighbours joined."""
    out: list[tuple[str, int, int]] = []
    for run, x, y in sorted(rows):
        if out and out[-1][0] == run and x <= out[-1][2] + 1:
            out[-1] = (run, out[-1][1], max(y, out[-1][2]))
        else:
            out.append((run, x, y))
    return out
