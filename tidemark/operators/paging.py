"""Key-ordered paging (PAG-1..4, AGG-5).

* :func:`page_first` / :func:`page_next` - one page at a time, keyset style:
  ``key > last_key ORDER BY key LIMIT n`` is a TakeOrderedAndProject (a top-n
  per task, then a merge of n rows per task), so fetching a page never sorts
  or shuffles the table.
* :class:`Pager` - the page model of the original: page index, start/end key,
  first row number, prev/next page, ``has_next`` and a running total.
* :func:`paginate` / :func:`page_summary` - every page at once. No global
  window: the table is range-partitioned by key, each task numbers its own
  rows (``monotonically_increasing_id`` keeps the in-partition position), and
  the row count of each range partition (one row per partition, a size bound
  set by the partition count) is broadcast as the base of that partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

# Fixed values that must equal the original's: the page model's default page
# size, and the size used when a scan is called without a page model.
DEFAULT_PAGE_SIZE = 100
DEFAULT_PAGE_SIZE_NO_MODEL = 10


def page_first(df: DataFrame, size: int = DEFAULT_PAGE_SIZE_NO_MODEL, start_key: str | None = None,
               key: str = "rowkey") -> DataFrame:
    """PAG-1: up to ``size`` rows in key order from ``start_key`` (inclusive),
    or from the first row when no start is given."""
    if start_key is not None:
        df = df.filter(F.col(key) >= F.lit(start_key))
    return df.orderBy(key).limit(size)


def page_next(df: DataFrame, last_key, size: int = DEFAULT_PAGE_SIZE_NO_MODEL, key: str = "rowkey") -> DataFrame:
    """PAG-2: the page after ``last_key`` (a value or a Column such as a
    scalar subquery). Strictly greater: a deleted boundary row cannot make
    the next page skip a live row."""
    lk = last_key if not isinstance(last_key, (str, int)) else F.lit(last_key)
    return df.filter(F.col(key) > lk).orderBy(key).limit(size)


@dataclass
class Pager:
    """PAG-3: the page model carried between calls. ``next()`` returns the
    next page as a DataFrame (cached: it is at most ``page_size`` rows) and
    updates the model from the page's boundary keys and size."""

    df: DataFrame
    page_size: int = DEFAULT_PAGE_SIZE
    key: str = "rowkey"
    start_key: str | None = None
    page_index: int = 0
    page_start_key: str | None = None
    page_end_key: str | None = None
    query_total_count: int = 0
    last_rows: int = 0
    by_row: bool = False  # page over rows of a multi-cell table (all cells of a row together)
    _pages: list = field(default_factory=list, repr=False)

    def next(self) -> DataFrame:
        if self.by_row:
            from tidemark.operators.cells import page_rows
            page = page_rows(self.df, self.page_size, after_key=self.page_end_key,
                             start_key=self.start_key if self.page_end_key is None else None)
        elif self.page_end_key is None:
            page = page_first(self.df, self.page_size, self.start_key, self.key)
        else:
            page = page_next(self.df, self.page_end_key, self.page_size, self.key)
        if self._pages:
            self._pages.pop().unpersist()
        page = page.cache()
        self._pages.append(page)
        n = F.countDistinct(self.key) if self.by_row else F.count(F.lit(1))
        s = page.agg(F.min(self.key).alias("a"), F.max(self.key).alias("b"), n.alias("n")).first()
        self.page_index += 1
        self.last_rows = int(s["n"])
        if self.last_rows > 0:
            self.page_start_key, self.page_end_key = s["a"], s["b"]
        self.query_total_count += self.last_rows
        return page

    def page_count(self) -> int:
        """Number of pages over the whole frame (rows, or distinct keys when
        paging by row): one count, not a fetch."""
        n = (self.df.select(self.key).distinct() if self.by_row else self.df).count()
        return -(-n // self.page_size)

    @property
    def first_row(self) -> int:
        return (self.page_index - 1) * self.page_size + 1

    @property
    def prev_page(self) -> int:
        return self.page_index - 1 if self.page_index > 1 else 1

    @property
    def next_page(self) -> int:
        return self.page_index + 1

    @property
    def has_next(self) -> bool:
        """The original's rule: a full page means there may be more (true on
        an exactly full last page)."""
        return self.last_rows == self.page_size


def paginate(df: DataFrame, size: int = DEFAULT_PAGE_SIZE, key: str = "rowkey",
             partitions: int | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """PAG-4: ``row_num`` (1-based key order) and ``page_index`` for every row.

    One range shuffle + in-partition sort, written once to the shared folder
    as Parquet with each row's partition and place in it, one tiny aggregate
    of per-partition counts (reading the partition column alone), and a
    broadcast of those counts (one row per range partition). ``tiebreak``
    columns order rows of one key and join the range bounds, so even a key
    holding a third of the rows is split over many range partitions; without
    them a hash of the whole row does, so numbers do not depend on the run."""
    order = [F.col(key), *(map(F.col, tiebreak) if tiebreak else [F.xxhash64(*df.columns)])]
    rng = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    tagged = rng.sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    path = scratch_dir(df.sparkSession, "paged")
    tagged.write.parquet(path)
    tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the running sum over this small frame is the base
    bases = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_base"))
    out = tagged.join(F.broadcast(bases), "_pid")
    row_num = F.coalesce(F.col("_base"), F.lit(0)) + F.col("_local") + 1
    return (out.withColumn("row_num", row_num.cast("bigint"))
            .withColumn("page_index", (F.floor((F.col("row_num") - 1) / size) + 1).cast("int"))
            .drop("_pid", "_local", "_base"))


def page_summary(paged: DataFrame, size: int = DEFAULT_PAGE_SIZE, key: str = "rowkey") -> DataFrame:
    """PAG-3 + AGG-5 for all pages: boundary keys, first row number,
    prev/next index, ``has_next`` by the original rule (page is full),
    ``has_next_exact`` (a later page exists) and ``total`` = rows fetched up
    to this page.

    Only the first and last row of every page matter, so the rows are cut to
    those edges (a narrow filter on ``row_num``) before grouping: the
    aggregation sees two rows per page, never the table. Every page before
    the last is full, so page sizes and the running total follow from the
    row count alone: no window over pages."""
    n = paged.agg(F.max("row_num")).first()[0] or 0  # total rows: one number
    rn = F.col("row_num")
    edges = paged.filter(((rn - 1) % size == 0) | (rn % size == 0) | (rn == n))
    pages = edges.groupBy("page_index").agg(F.min(key).alias("start_key"), F.max(key).alias("end_key"),
                                            F.max("row_num").alias("_last"))
    idx = F.col("page_index")
    rows = F.least(F.lit(size).cast("bigint"), n - (idx - 1) * size).cast("bigint")
    return pages.select(
        idx,
        "start_key", "end_key",
        ((idx - 1) * size + 1).cast("bigint").alias("first_row"),
        F.when(idx > 1, idx - 1).otherwise(F.lit(1)).cast("int").alias("prev_page"),
        (idx + 1).cast("int").alias("next_page"),
        (rows == size).alias("has_next"),
        (F.col("_last") < n).alias("has_next_exact"),
        rows.alias("rows"),
        ((idx - 1) * size + rows).cast("bigint").alias("total"),
    )
