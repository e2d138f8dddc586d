"""Offset management as DataFrame work (OFF-1..11, SET-1, SET-2, SRC-2,
SRC-3, SRC-5, SNK-2).

Every frame here is keyed by (topic, partition) or (group, topic, partition),
so the *stored* side has one row per topic partition: its size is bounded
by the partition count of the subscribed topics, never by the data. Whether
it is broadcast to records is left to Spark, which knows its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import delete_path, exists, list_dirs

TP = ["topic", "partition"]


def offset_ranges(records: DataFrame, by: list[str] | None = None,
                  previous: DataFrame | None = None) -> DataFrame:
    """OFF-1: ``from_offset`` (inclusive), ``until_offset`` (exclusive) and the
    record count per topic partition of a batch (``by`` adds grouping, e.g.
    ``batch_id`` for a bounded log). Partial aggregation: a partition holding
    a third of the batch still reaches the shuffle as one row per task.

    ``previous`` (topic, partition, offset = last until) keeps partitions that
    were idle in this batch, with from = until = the previous position; with
    compacted topics ``record_count`` can be below ``until - from``."""
    by = by or []
    ranges = records.groupBy(*by, *TP).agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("record_count"),
    )
    if previous is None:
        return ranges
    if by:
        raise ValueError("previous positions apply to a single batch (no 'by' grouping)")
    prev = previous.select(*TP, F.col("offset").alias("_prev"))
    idle = prev.join(ranges.select(*TP), TP, "left_anti").select(
        *TP, F.col("_prev").alias("from_offset"), F.col("_prev").alias("until_offset"),
        F.lit(0).cast("bigint").alias("record_count"))
    return ranges.unionByName(idle, allowMissingColumns=True)


def latest_offsets(log: DataFrame, group_id: str | None = None, topics: list[str] | None = None,
                   position: str = "until_offset") -> DataFrame:
    """SRC-5 / OFF-6: latest stored position per (group, topic, partition):
    the value of the newest (run_id, batch_id) write, i.e. the last
    ``replace into`` for that key."""
    if group_id is not None:
        log = log.filter(F.col("group_id") == group_id)
    if topics:
        log = log.filter(F.col("topic").isin(topics))
    order = F.struct(*[c for c in ("run_id", "batch_id") if c in log.columns]) \
        if any(c in log.columns for c in ("run_id", "batch_id")) else F.col(position)
    return log.groupBy("group_id", *TP).agg(F.max_by(F.col(position), order).alias("offset"))


def found_flags(log: DataFrame, groups: list[str], topic: str) -> DataFrame:
    """OFF-6 flag per asked group: 1 when the group has anything stored for
    ``topic``, else 0 (start from the default position)."""
    spark = log.sparkSession
    asked = spark.createDataFrame([(g, 0) for g in groups], "group_id string, found int")
    present = (log.filter((F.col("topic") == topic) & F.col("group_id").isin(list(groups)))
               .select("group_id", F.lit(1).alias("found")))
    # no join: the asked groups (found 0) and the stored rows (found 1) are
    # unioned and reduced per group; partial aggregation keeps it one row
    # per group per task
    return asked.unionByName(present).groupBy("group_id").agg(F.max("found").cast("int").alias("found"))


def add_new_partitions(stored: DataFrame, current: DataFrame, start: int = 0) -> DataFrame:
    """OFF-7 = SET-1 + SET-2: partitions in ``current`` (topic, partition) but
    not in ``stored`` (topic, partition, offset) are added at ``start``."""
    new = current.select(*TP).join(stored.select(*TP), TP, "left_anti") \
        .withColumn("offset", F.lit(start).cast("bigint"))
    return stored.select(*TP, "offset").unionByName(new)


def earliest_available(records: DataFrame) -> DataFrame:
    """The first offset still present per partition (after retention)."""
    return records.groupBy(*TP).agg(F.min("offset").alias("earliest"))


def clamp_to_earliest(stored: DataFrame, earliest: DataFrame) -> DataFrame:
    """OFF-8: a stored offset older than the earliest available one starts at
    the earliest instead of failing; partitions with no data keep theirs."""
    e = earliest.select(*TP, "earliest")
    return (stored.join(e, TP, "left")
            .select(*[c for c in stored.columns if c != "offset"],
                    F.greatest(F.col("offset"), F.coalesce(F.col("earliest"), F.col("offset"))).alias("offset")))


def positions_predicate(positions: list[tuple[str, int, int]], assign: bool = False):
    """The stored positions as one plain predicate: ``(topic, partition) =
    (t, p) AND offset >= s`` per stored partition, OR-ed; in Subscribe mode
    partitions without a stored position pass whole. Unlike a join it is
    pushed into the parquet scan, so row groups below the stored offsets are
    skipped. The terms form a balanced tree, so thousands of partitions nest
    only a few levels deep."""
    if not positions:
        return F.lit(not assign)
    terms = [(F.col("topic") == t) & (F.col("partition") == int(p)) & (F.col("offset") >= int(o))
             for t, p, o in positions]
    while len(terms) > 1:
        terms = [a | b for a, b in zip(terms[::2], terms[1::2])] + (terms[-1:] if len(terms) % 2 else [])
    cond = terms[0]
    if not assign:
        by_topic: dict[str, list[int]] = {}
        for t, p, _ in positions:
            by_topic.setdefault(t, []).append(int(p))
        unstored = None
        for t, ps in by_topic.items():
            c = (F.col("topic") == t) & ~F.col("partition").isin(ps)
            unstored = c if unstored is None else unstored | c
        cond = cond | unstored | ~F.col("topic").isin(list(by_topic))
    return cond


def resume_from_positions(records: DataFrame, positions: list[tuple[str, int, int]],
                          assign: bool = False) -> DataFrame:
    """SRC-2 / SRC-3 with driver-side positions (one per topic partition): a
    filter that is pushed down, at any partition count."""
    return records.filter(positions_predicate(positions, assign))


def _starts(stored: DataFrame) -> DataFrame:
    """The stored side of a resume, one row per topic partition: Spark
    broadcasts it while its size allows."""
    return stored.select(*TP, F.col("offset").alias("_start"))


def resume_subscribe(records: DataFrame, stored: DataFrame, default_start: str = "earliest") -> DataFrame:
    """SRC-2: read a bounded topic from stored offsets in Subscribe mode.
    Partitions missing from ``stored`` start at the default position
    (``earliest`` = everything, ``latest`` = nothing already written)."""
    j = records.join(_starts(stored), TP, "left")
    if default_start == "earliest":
        cond = F.col("_start").isNull() | (F.col("offset") >= F.col("_start"))
    elif default_start == "latest":
        cond = F.col("_start").isNotNull() & (F.col("offset") >= F.col("_start"))
    else:
        raise ValueError("default_start must be 'earliest' or 'latest'")
    return j.filter(cond).drop("_start")


def resume_assign(records: DataFrame, stored: DataFrame) -> DataFrame:
    """SRC-3: Assign mode reads only the stored partitions, from their offsets."""
    return records.join(_starts(stored), TP, "inner").filter(F.col("offset") >= F.col("_start")).drop("_start")


def start_positions(log: DataFrame, group_id: str, commit: str = "after",
                    topics: list[str] | None = None) -> DataFrame:
    """STR-3 / OFF-9: where a restarted consumer begins. ``commit='after'``
    stored the batch's until (at-least-once, nothing repeats when the last
    write landed); ``commit='before'`` stored the batch's from before the
    work, so the last batch is always read again."""
    pos = "until_offset" if commit == "after" else "from_offset"
    return latest_offsets(log, group_id, topics, position=pos).select(*TP, "offset")


def range_report(ranges: DataFrame) -> DataFrame:
    """OFF-11: one ``---topic,partition,from,until`` line per range."""
    return ranges.select(*[c for c in ranges.columns],
                         F.concat(F.lit("---"), F.concat_ws(",", "topic", F.col("partition").cast("string"),
                                                            F.col("from_offset").cast("string"),
                                                            F.col("until_offset").cast("string"))).alias("line"))


# Fixed value that must equal the original's: root of the per-partition path store.
OFFSET_PATH_ROOT = "/kafka/offsets"


def offset_paths(latest: DataFrame, root: str = OFFSET_PATH_ROOT) -> DataFrame:
    """OFF-5 / D7: the per-partition path form ``<root>/<group>/<topic>/<partition>``
    with the offset as text, for stores keyed by path."""
    return latest.select(
        F.concat_ws("/", F.lit(root), "group_id", "topic", F.col("partition").cast("string")).alias("path"),
        F.col("offset").cast("string").alias("data"))


def offsets_from_paths(entries: DataFrame, root: str = OFFSET_PATH_ROOT) -> DataFrame:
    """Inverse of :func:`offset_paths`: (path, data) entries of a path store
    back to (group_id, topic, partition, offset). Entries outside ``root`` or
    with a non-numeric value raise."""
    parts = F.split(F.substr(F.col("path"), F.lit(len(root) + 2)), "/")
    ok = (F.col("path").startswith(root + "/") & (F.size(parts) == 3) & parts[2].rlike(r"^[0-9]+$")
          & F.trim(F.col("data")).rlike(r"^-?[0-9]+$"))
    bad = F.raise_error(F.lit("malformed offset path entry"))
    return entries.select(
        F.when(ok, parts[0]).otherwise(bad).alias("group_id"),
        F.when(ok, parts[1]).otherwise(bad).alias("topic"),
        F.when(ok, parts[2].cast("int")).otherwise(bad).alias("partition"),
        F.when(ok, F.trim(F.col("data")).cast("bigint")).otherwise(bad).alias("offset"))


def from_sql_offset_table(df: DataFrame) -> DataFrame:
    """D5: rows of a SQL offset table ``(topic, groupid, partitions,
    fromoffset, untiloffset)`` - e.g. read with ``spark.read.jdbc`` - in the
    offset-log shape, so :func:`latest_offsets` applies unchanged. Such a
    table keeps one row per key (``replace into``), so no batch order is
    needed."""
    return df.select(F.col("groupid").cast("string").alias("group_id"), F.col("topic").cast("string").alias("topic"),
                     F.col("partitions").cast("int").alias("partition"),
                     F.col("fromoffset").cast("bigint").alias("from_offset"),
                     F.col("untiloffset").cast("bigint").alias("until_offset"))


class OffsetLog:
    """Offsets in a plain table (SNK-2, OFF-4, OFF-5, OFF-10): one parquet
    partition per (run_id, batch_id) written with dynamic overwrite, so a
    replayed batch replaces its rows (the SQL ``replace into``) and a crash
    never leaves half a batch: the partition appears whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def append(self, ranges: DataFrame, group_id: str, run_id: str, batch_id: int) -> None:
        (ranges.select(F.lit(group_id).alias("group_id"), *TP, "from_offset", "until_offset",
                       F.coalesce(F.col("record_count"), F.lit(0)).cast("bigint").alias("record_count")
                       if "record_count" in ranges.columns else F.lit(None).cast("bigint").alias("record_count"))
         .withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .coalesce(1)  # one small file per batch: rows = topic partitions
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").parquet(self.path))

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schemas.OFFSET_LOG_STORED)
        return self.spark.read.schema(schemas.OFFSET_LOG_STORED).parquet(self.path)

    def fold(self) -> int:
        """Remove batch folders that hold no latest position of their run. One
        listing says what may be removed: a batch that lands meanwhile is not
        in it, and a reader at any moment finds every latest position. Returns
        how many were removed."""
        listed = {(run[7:], int(batch[9:])) for run in list_dirs(self.spark, self.path) if run.startswith("run_id=")
                  for batch in list_dirs(self.spark, f"{self.path}/{run}") if batch.startswith("batch_id=")}
        newest = (self.read().groupBy("group_id", *TP, "run_id").agg(F.max("batch_id").alias("batch_id"))
                  .select("run_id", "batch_id").distinct().collect())  # one row per topic partition at most
        keep, last = {(r.run_id, r.batch_id) for r in newest}, {}
        for run, b in keep:
            last[run] = max(b, last.get(run, b))
        gone = [(run, b) for run, b in listed - keep if b < last.get(run, -1)]
        for run, b in gone:
            delete_path(self.spark, f"{self.path}/run_id={run}/batch_id={b}")
        return len(gone)

    def latest(self, group_id: str, topics: list[str] | None = None, commit: str = "after") -> DataFrame:
        return start_positions(self.read(), group_id, commit, topics)

    def get_offsets(self, group_id: str, topics: list[str]) -> tuple[DataFrame, int]:
        """OFF-6: stored offsets of the first topic plus a found flag (1 when
        anything is stored). The flag is one ``isEmpty`` probe, not a collect."""
        df = self.latest(group_id, topics[:1])
        return df, 0 if df.isEmpty() else 1
