"""Exact dedup by a content sort.

Normalised texts are range-partitioned between sampled splitters, sorted in
each partition (Spark's external sort), and each row is compared in full with
its neighbour. Equal texts stand side by side, so runs of equal neighbours are
the groups; a run that reaches the end of a partition is joined with the run
that goes on in the next one.

The sort key is (first characters, SHA-256, text, id): splitters are sampled
from its short part, so sampling stays small however long texts are, and the
id (and the row's number) at its end lets one group of copies span many
partitions instead of filling one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, id_type, partitions_for, slices, small_batches, stored, text_of, whole_rows

#: Characters of a text that splitters are sampled from, beside its SHA-256.
SPLITTER_CHARS = 32
PARTITION_BYTES = 32 << 20


def normalised(c):
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(c, r"[\x20\x09-\x0D]+", " ")


def _runs(id_arrow: pa.DataType):
    fields = [pa.field("doc_id", id_arrow), pa.field("text_sha256", pa.string()), pa.field("n_bytes", pa.int64()),
              pa.field("part", pa.int32()), pa.field("run", pa.int64()), pa.field("first", pa.bool_()),
              pa.field("run_id", id_arrow), pa.field("run_rows", pa.int64()), pa.field("edge", pa.bool_())]

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out = {f.name: [] for f in fields}
        run, ids, text, sha = 0, [], None, None

        def close(edge: bool) -> None:
            n = len(ids)
            for name, values in (("doc_id", ids), ("text_sha256", [sha] * n), ("n_bytes", [len(text)] * n),
                                 ("part", [part] * n), ("run", [run] * n),
                                 ("first", [True] + [False] * (n - 1)), ("run_id", ids[:1] * n),
                                 ("run_rows", [n] * n), ("edge", [edge] * n)):
                out[name] += values

        for batch in batches:
            for piece in slices([batch], "norm"):
                norms = piece.column("norm").cast(pa.binary()).to_pylist()
                rows = zip(norms, piece.column("doc_id").to_pylist(), piece.column("sha").to_pylist(), strict=True)
                for norm, doc_id, its_sha in rows:
                    if norm != text:
                        if ids:
                            close(edge=run == 0)
                            run += 1
                        ids, text, sha = [], norm, its_sha
                    ids.append(doc_id)
                if len(out["run"]) > 10_000:
                    yield arrow_rows(fields, out)
                    out = {f.name: [] for f in fields}
        if ids:
            close(edge=True)
            yield arrow_rows(fields, out)

    return number


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 partitions: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (smallest doc_id of the
    equal texts), group_size, kept (true for exactly one row of a group),
    text_sha256 and n_bytes of the normalised text.

    A null text counts as empty; empty texts are equal. A null id counts as
    larger than any other: such a row stays only if its whole group has null
    ids (keep_id is null then). Of rows repeated with the same id and text one
    stays. Only the id and text columns are read, so other columns may have
    any name. An empty frame gives an empty result.
    """
    norm = docs.select(F.col(id_col).alias("doc_id"), normalised(text_of(docs, text_col)).alias("norm"))
    norm = norm.withColumns({"sha": F.sha2("norm", 256), "lead": F.substring("norm", 1, SPLITTER_CHARS),
                             "row": F.monotonically_increasing_id()})
    parts = partitions or partitions_for(docs, PARTITION_BYTES)
    by_id = F.col("doc_id").asc_nulls_last()
    dealt = (norm.repartitionByRange(parts, "lead", "sha", by_id, "row")
             .sortWithinPartitions("lead", "sha", "norm", by_id, "row").select("doc_id", "norm", "sha"))
    kind = id_type(docs, id_col)
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("text_sha256", T.StringType()),
                           T.StructField("n_bytes", T.LongType()), T.StructField("part", T.IntegerType()),
                           T.StructField("run", T.LongType()), T.StructField("first", T.BooleanType()),
                           T.StructField("run_id", kind), T.StructField("run_rows", T.LongType()),
                           T.StructField("edge", T.BooleanType())])
    with small_batches(docs.sparkSession):
        runs = stored(dealt.mapInArrow(_runs(to_arrow_type(kind)), schema), "exact-runs")

    # Two rows at most for each partition: its first and its last run.
    in_order = Window.orderBy("part", "run")
    edges = (runs.where("edge and first").select("part", "run", "run_id", "run_rows", "text_sha256", "n_bytes")
             .withColumn("goes_on", F.coalesce(
                 (F.lag("text_sha256").over(in_order) == F.col("text_sha256"))
                 & (F.lag("n_bytes").over(in_order) == F.col("n_bytes")), F.lit(False)))
             .withColumn("chain", F.sum((~F.col("goes_on")).cast("long")).over(in_order)))
    whole = Window.partitionBy("chain").orderBy("part", "run").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select("part", "run", "goes_on", F.first("run_id").over(whole).alias("chain_id"),
                         F.sum("run_rows").over(whole).alias("chain_rows"))
    return (runs.join(F.broadcast(edges), ["part", "run"], "left")
            .select("doc_id", F.when(F.col("edge"), F.col("chain_id")).otherwise(F.col("run_id")).alias("keep_id"),
                    F.coalesce("chain_rows", "run_rows").alias("group_size"),
                    (F.col("first") & ~F.coalesce("goes_on", F.lit(False))).alias("kept"),
                    "text_sha256", "n_bytes"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these
    are called. A null text counts as empty, so of null, empty and equal texts
    one row stays. Rows repeated with one id and equal texts leave one row.
    Null ids and ties as in ``exact_groups``; an empty frame stays empty."""
    # Id and key in one struct, which is never null: null ids are equal, and the
    # join has dealt and sorted the rows as dropping repeated ones asks for.
    stay = (exact_groups(docs, id_col, text_col).where("kept")
            .select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("key")).alias("who")))
    rows = (whole_rows(docs, id_col, F.sha2(normalised(text_of(docs, text_col)), 256))
            .select(F.struct("id", "key").alias("who"), "whole"))
    return rows.join(stay, "who", "left_semi").dropDuplicates(["who"]).select("whole.*")
