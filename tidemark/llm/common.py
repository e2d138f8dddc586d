"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_dir

#: The ASCII letters, for lower-casing A-Z alone (``lower`` would also change
#: letters outside ASCII).
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Spark's estimate for a frame of unknown size is far above any real one.
UNKNOWN_BYTES = 1 << 60


#: The folder that holds the package.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed but lies
    in a folder they see too (a checkout; elsewhere it goes by --py-files)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, HOME])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the frame's size (file sizes for a scan)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """Partitions of about ``bytes_each``, and no fewer than the session's;
    just these if Spark does not know the size."""
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = plan_bytes(df)
    return session if size >= UNKNOWN_BYTES else max(session, -(-size // bytes_each))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: it cuts the
    lineage, survives lost executors and fixes numbers given to rows."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def storable(df: DataFrame) -> bool:
    """Whether ``stored`` can write the frame: Parquet has no void and no
    interval columns."""
    return not any(t in f.dataType.simpleString() for f in df.schema for t in ("void", "interval"))


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame. Made from a list, it would start Python workers of RDD
    jobs, which stay in memory beside those of the operators."""
    return spark.range(0, 0, 1, 1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def local_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A frame of long columns from rows of the driver; as ``no_rows``, without
    Python workers."""
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)}))


def id_type(docs: DataFrame, id_col: str) -> T.DataType:
    return docs.schema[id_col].dataType


def lower_ascii(c):
    return F.translate(c, UPPER, LOWER)


def arrow_rows(fields: list[pa.Field], rows: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in fields],
                                      schema=pa.schema(fields))


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``most`` bytes in each: long
    texts then never pile up in one step. A single longer text stays whole."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000):
    """Arrow batches of at most so many rows while an action runs: a Python
    worker then holds a few megabytes of texts at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_of(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def whole_rows(docs: DataFrame, id_col: str, key) -> DataFrame:
    """id, key and whole, a struct of all columns: no name of theirs can clash
    with what an operator adds."""
    return docs.select(F.col(id_col).alias("id"), key.alias("key"),
                       F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("whole"))


def let(value, body):
    """``body`` over a value that is computed once: an expression that a
    lambda refers to would else be put into it, and run for each element."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), 0)
