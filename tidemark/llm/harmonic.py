"""Harmonic packing: classes of reciprocal capacity, each with a fixed number
of pieces a sequence.

Documents may be cut, so each is cut at its length's binary digits: whole
sequences first, then at most one piece of each class capacity / 2, capacity /
4, ... 1, longest first. That is the least number of pieces of such lengths,
and a sequence of class ``capacity / k`` holds exactly ``k`` pieces with no
room left. Every worker fills the sequences of each class from its own pieces
alone. What it is left with, fewer than ``k`` pieces of each class, is numbered
over all workers by their counts and fills sequences in the same way; the
fewer than ``k`` pieces of a class that remain in the end lie in sequences of
1, 2, 4, ... pieces, whose lengths are powers of two. So nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, id_type, slices, small_batches, stored, text_of
from .encoding import encoder

#: Parts of a sequence number: class, worker (partition), sequence in them. The
#: last worker number stands for all workers' leftovers.
CLASS_BITS, PART_BITS, BIN_BITS = 5, 26, 32
ALL_PARTS = (1 << PART_BITS) - 1


def cuts(length: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: capacities, then its binary digits."""
    whole, rest = divmod(length, capacity)
    return [capacity] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _pieces(path: str, kind: str, end_id: int, capacity: int, id_arrow: pa.DataType):
    fields = [pa.field("doc_id", id_arrow), pa.field("start", pa.int64()), pa.field("length", pa.int64()),
              pa.field("ids_crc32", pa.int64()), pa.field("doc_tokens", pa.int64()), pa.field("part", pa.int32()),
              pa.field("bin", pa.int64()), pa.field("place", pa.int64())]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        if part >= ALL_PARTS:
            raise ValueError("too many partitions for sequence numbers")
        encode = encoder(path, kind).encode
        # the open sequence of each class: its pieces, fewer than capacity / length of them
        waiting: dict[int, list[tuple]] = {1 << k: [] for k in range(capacity.bit_length())}
        filled = dict.fromkeys(waiting, 0)
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   encode(batch.column("text").to_pylist()), strict=True):
                raw = ids.astype("<u4").tobytes() + end_id.to_bytes(4, "little")
                tokens, start = len(raw) // 4, 0
                for length in cuts(tokens, capacity):
                    pieces = waiting[length]
                    crc = zlib.crc32(raw[4 * start:4 * (start + length)])
                    pieces.append((doc_id, start, length, crc, tokens, part, filled[length], len(pieces)))
                    start += length
                    if len(pieces) * length == capacity:
                        out += pieces
                        waiting[length] = []
                        filled[length] += 1
            if out:
                yield rows(out)
        left = [(*p[:6], None, p[7]) for pieces in waiting.values() for p in pieces]
        if left:
            yield rows(left)

    def rows(some: list[tuple]) -> pa.RecordBatch:
        return arrow_rows(fields, dict(zip((f.name for f in fields), map(list, zip(*some, strict=True)), strict=True)))

    return cut


def _highest_bit(c):
    return F.length(F.bin(c)) - 1


def pack_harmonic(docs: DataFrame, tokenizer: str, kind: str = "whole", capacity: int = 4096, end_id: int = 2,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    ``tokenizer`` is a file that executors can open; ``kind`` as in
    ``encoding.CachedEncoder``; ``capacity`` is a power of two. Every sequence
    is full or as long as a power of two. A null or empty text is the end id
    alone. Rows repeated with one id are packed each by itself; ids may be
    null; an empty frame gives no rows.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    if capacity.bit_length() > 1 << CLASS_BITS:
        raise ValueError("capacity is too large")
    kind_of_id = id_type(docs, id_col)
    schema = T.StructType([T.StructField("doc_id", kind_of_id)] + [T.StructField(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens")] + [T.StructField("part", T.IntegerType())] + [
        T.StructField(n, T.LongType()) for n in ("bin", "place")])
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    with small_batches(docs.sparkSession):
        pieces = stored(texts.mapInArrow(_pieces(tokenizer, kind, end_id, capacity, to_arrow_type(kind_of_id)), schema),
                        "harmonic-pieces")

    full = pieces.where("bin is not null")
    # fewer than capacity / length pieces of each class and worker
    left = pieces.where("bin is null").drop("bin")
    counts = left.groupBy("length", "part").agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("length")
    bases = counts.select(
        "length", "part", F.sum("n").over(of_class).alias("total"),
        F.coalesce(F.sum("n").over(of_class.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("base"))
    left = (left.join(bases, ["length", "part"])
            .withColumn("rank", F.col("base") + F.col("place"))
            .withColumn("each", F.expr(f"{capacity}L div length")))
    bins, last, at = F.expr("total div each"), F.col("total") % F.col("each"), F.col("rank") % F.col("each")
    in_full = F.expr("rank div each") < bins
    # of the last pieces, piece ``at`` lies in the sequence of the highest
    # binary digit of their number that ``at`` does not have
    digit = _highest_bit(last.bitwiseXOR(at))
    left = left.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.lit(ALL_PARTS).alias("part"),
        F.when(in_full, F.expr("rank div each")).otherwise(bins + digit).alias("bin"),
        F.when(in_full, at).otherwise(
            at.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), digit) - 1)).alias("place"))
    number = (_highest_bit(F.col("length")).cast("long") * (1 << PART_BITS + BIN_BITS)
              + F.col("part").cast("long") * (1 << BIN_BITS) + F.col("bin"))
    return full.unionByName(left).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                         number.alias("sequence_id"),
                                         (F.col("place") * F.col("length")).alias("offset"))
