"""The ``"partition:offset,partition:offset"`` offset string (OFF-2, OFF-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.common import col_of


def encode_offsets(df: DataFrame, group_cols: list[str], partition: str = "partition",
                   offset: str = "until_offset", out: str = "offsets") -> DataFrame:
    """OFF-2: one string per group, entries sorted by partition.
    The list per group has one entry per topic partition (bounded by the
    topic's partition count), so collecting it per group is safe."""
    entry = F.struct(col_of(partition).cast("int").alias("p"), col_of(offset).cast("bigint").alias("o"))
    agg = df.groupBy(*group_cols).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    return agg.select(
        *group_cols,
        F.array_join(F.transform("_e", lambda e: F.concat_ws(":", e["p"].cast("string"), e["o"].cast("string"))),
                     ",").alias(out),
    )


def _fail(msg: str) -> Column:
    return F.raise_error(F.lit(msg))


def decode_offsets(df: DataFrame, col: str = "offsets", keep: list[str] | None = None) -> DataFrame:
    """OFF-3: explode the string into (partition, offset) rows. A malformed
    entry (not exactly ``int:long``) or an empty string raises, as parsing the
    string does in the original."""
    keep = keep or []
    entries = df.select(*keep, F.explode(F.split(F.col(col), ",")).alias("_entry"))
    parts = F.split("_entry", ":")
    ok = (F.size(parts) == 2) & parts[0].rlike(r"^-?[0-9]+$") & parts[1].rlike(r"^-?[0-9]+$")
    return entries.select(
        *keep,
        F.when(ok, parts[0].cast("int")).otherwise(_fail("malformed offset entry")).alias("partition"),
        F.when(ok, parts[1].cast("bigint")).otherwise(_fail("malformed offset entry")).alias("offset"),
    )
