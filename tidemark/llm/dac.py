"""Token ids in directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS``. Level 0 holds the lowest chunk of
every id, level k the k-th chunk of those ids that have one. Each level has a
bitmap that says whether an id goes on in the next level, and a rank directory
(ones before each block of the bitmap), so the chunks of any one id are found
with one rank per level; nothing before it is decoded.

A file is a Parquet dataset with one row per segment of about
``SEGMENT_TOKENS`` ids. Segments follow ascending document ids: the partition
number and the segment number in it are their order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, id_type, partitions_for, slices, small_batches, text_of
from .encoding import encoder

CHUNK_BITS = 8
#: Bits of a bitmap for which the rank directory has one entry.
RANK_BLOCK = 512
SEGMENT_TOKENS = 1 << 20
PARTITION_BYTES = 32 << 20

LEVEL = pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("rank", pa.binary())])


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Ids (unsigned) to levels; no ids: one empty level."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        chunk = (rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> np.uint64(CHUNK_BITS)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.int64) if len(more) else []
        rank = np.cumsum(np.concatenate([[0], ones])).astype("<u4")
        levels.append({"chunks": chunk.tobytes(), "more": bits.tobytes(), "rank": rank.tobytes()})
        rest = rest[more]
        if not len(rest):
            return levels


def decode_levels(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment, as unsigned 32-bit numbers."""
    ids, at = None, None
    for k, level in enumerate(levels):
        chunk = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        if ids is None:
            ids, at = chunk.copy(), np.arange(len(chunk))
        else:
            ids[at] |= chunk << np.uint32(CHUNK_BITS * k)
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(chunk), bitorder="little")
        at = at[more.astype(bool)]
    return ids


def token_in(levels: list[dict[str, bytes]], index: int) -> int:
    """One id of a segment, by rank alone."""
    value = 0
    for k, level in enumerate(levels):
        value |= level["chunks"][index] << (CHUNK_BITS * k)
        byte, bit = divmod(index, 8)
        if not level["more"][byte] >> bit & 1:
            break
        block = index // RANK_BLOCK
        before = np.frombuffer(level["more"][block * RANK_BLOCK // 8:byte + 1], np.uint8)
        ones = int(np.unpackbits(before, bitorder="little")[:index - block * RANK_BLOCK].sum())
        index = int(np.frombuffer(level["rank"], "<u4")[block]) + ones
    return value


def _segments(path: str, kind: str, end_id: int, id_arrow: pa.DataType):
    fields = [pa.field("part", pa.int32()), pa.field("segment", pa.int64()), pa.field("start_in_part", pa.int64()),
              pa.field("n_tokens", pa.int64()), pa.field("doc_ids", pa.list_(id_arrow)),
              pa.field("doc_tokens", pa.list_(pa.int64())), pa.field("levels", pa.list_(LEVEL))]

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        encode = encoder(path, kind).encode
        doc_ids, arrays, held = [], [], 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "segment": segment, "start_in_part": start, "n_tokens": held, "doc_ids": doc_ids,
                   "doc_tokens": [len(a) for a in arrays], "levels": encode_levels(np.concatenate(arrays))}
            return arrow_rows(fields, {k: [v] for k, v in row.items()})

        for batch in slices(batches, "text"):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   encode(batch.column("text").to_pylist()), strict=True):
                if held and held + len(ids) + 1 > SEGMENT_TOKENS:
                    yield close()
                    segment, start = segment + 1, start + held
                    doc_ids, arrays, held = [], [], 0
                doc_ids.append(doc_id)
                arrays.append(np.append(ids, ids.dtype.type(end_id)))
                held += len(ids) + 1
        if held:
            yield close()

    return write


def write_tokens(docs: DataFrame, path: str, tokenizer: str, kind: str = "whole", end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` to each and write the ids in
    ascending order of document ids (nulls first; rows with one id in the
    order of a hash of their text). A null text is empty: its end id alone. An
    empty frame writes a dataset without rows."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    texts = (texts.repartitionByRange(partitions or partitions_for(docs, PARTITION_BYTES), *order)
             .sortWithinPartitions(*order).select("doc_id", "text"))
    level = "array<struct<chunks:binary,more:binary,rank:binary>>"
    kind_of_id = id_type(docs, id_col)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("segment", T.LongType()),
                           T.StructField("start_in_part", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("doc_ids", T.ArrayType(kind_of_id)),
                           T.StructField("doc_tokens", T.ArrayType(T.LongType())),
                           T.StructField("levels", T._parse_datatype_string(level))])
    with small_batches(docs.sparkSession):
        (texts.mapInArrow(_segments(tokenizer, kind, end_id, to_arrow_type(kind_of_id)), schema)
         .write.option("compression", "none").parquet(path))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a file with ``start``, the ids of all segments before.
    Starts are added up over one row per partition and broadcast."""
    segments = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (segments.join(F.broadcast(bases), "part")
            .withColumn("start", F.col("base") + F.col("start_in_part")).drop("base"))


def _documents(id_arrow: pa.DataType):
    fields = [pa.field("doc_id", id_arrow), pa.field("start", pa.int64()), pa.field("n_tokens", pa.int64()),
              pa.field("ids_crc32", pa.int64())]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = decode_levels(row.column("levels").to_pylist()[0]).astype("<u4")
                counts = np.array(row.column("doc_tokens").to_pylist()[0], np.int64)
                ends = np.cumsum(counts)
                begins, raw = ends - counts, memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                start = row.column("start")[0].as_py()
                yield arrow_rows(fields, {"doc_id": row.column("doc_ids").to_pylist()[0],
                                          "start": (begins + start).tolist(), "n_tokens": counts.tolist(),
                                          "ids_crc32": crc})

    return read


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each document from its ids in the file: doc_id, start, n_tokens and
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers)."""
    segments = read_segments(spark, path)
    kind = segments.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return (segments.select("doc_ids", "doc_tokens", "levels", "start")
            .mapInArrow(_documents(to_arrow_type(kind)), schema))


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """The ids at global positions: (position, token_id), one row per distinct
    position within the file. Positions meet their segment on a cell of
    ``SEGMENT_TOKENS`` positions; the wanted ids are then found by rank."""
    segments = read_segments(spark, path)
    cells = segments.withColumn("cell", F.explode(F.sequence(
        F.expr(f"start div {SEGMENT_TOKENS}"), F.expr(f"(start + n_tokens - 1) div {SEGMENT_TOKENS}"))))
    wanted = (positions.select(F.col(position_col).cast("long").alias("position")).where("position is not null")
              .distinct().withColumn("cell", F.expr(f"position div {SEGMENT_TOKENS}")))
    hit = (cells.select("part", "segment", "start", "n_tokens", "cell").join(wanted, "cell")
           .where("position >= start and position < start + n_tokens")
           .groupBy("part", "segment").agg(F.collect_list("position").alias("positions")))

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field("position", pa.int64()), pa.field("token_id", pa.int64())]
        for batch in batches:
            for row in batch.to_pylist():
                yield arrow_rows(fields, {"position": row["positions"], "token_id": [
                    token_in(row["levels"], p - row["start"]) for p in row["positions"]]})

    return (segments.join(hit, ["part", "segment"]).select("positions", "levels", "start")
            .mapInArrow(look, "position long, token_id long"))
