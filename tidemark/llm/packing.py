"""Best-fit packing planned on a histogram of lengths.

Documents become token pieces of at most ``capacity`` ids. Only the number of
pieces of each length (``capacity`` rows at most) goes to the driver; best-fit
decreasing runs over those counts and gives, for each length, which ranks go
to which sequences and at which place. Pieces then take their planned slot by
a join on (length, rank within length). Ranks are numbered per partition and
added up over partitions, so a length that a third of all pieces have is
nobody's single sort.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, id_type, local_rows, slices, small_batches, stored, text_of
from .encoding import encoder


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over {length: pieces}. Returns slots (length,
    first rank, number, first sequence, offset): the pieces of that length
    with ranks from the first on go to the sequences from the first on, one
    each, at the offset."""
    slots: list[tuple[int, int, int, int, int]] = []
    open_by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first sequence, number)
    rooms: list[int] = []
    opened = 0

    def put(room: int, first: int, number: int) -> None:
        if number and room:
            if not open_by_room[room]:
                bisect.insort(rooms, room)
            open_by_room[room].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms.pop(at)
            else:
                room, first, number = capacity, opened, -(-left // (capacity // length))
                opened += number
            each = min(room // length, left)  # a sequence is filled before the next one gets a piece
            used = min(number, left // each)
            for k in range(each):
                slots.append((length, rank, used, first, capacity - room + k * length))
                rank += used
            left -= used * each
            put(room - each * length, first, used)
            put(room, first + used, number - used)
    return slots


def _pieces(path: str, kind: str, end_id: int, capacity: int, id_arrow: pa.DataType):
    fields = [pa.field("doc_id", id_arrow), pa.field("piece", pa.int32()), pa.field("start", pa.int64()),
              pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64()),
              pa.field("part", pa.int32()), pa.field("rank_in_part", pa.int64())]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        encode = encoder(path, kind).encode
        for batch in slices(batches, "text"):
            out = {f.name: [] for f in fields}
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   encode(batch.column("text").to_pylist()), strict=True):
                raw = np.append(ids.astype("<u4"), np.uint32(end_id)).tobytes()
                for k in range(0, len(raw), 4 * capacity):
                    piece = raw[k:k + 4 * capacity]
                    length = len(piece) // 4
                    for name, value in (("doc_id", doc_id), ("piece", k // (4 * capacity)), ("start", k // 4),
                                        ("length", length), ("ids_crc32", zlib.crc32(piece)), ("part", part),
                                        ("rank_in_part", seen[length])):
                        out[name].append(value)
                    seen[length] += 1
            yield arrow_rows(fields, out)

    return cut


def pack(docs: DataFrame, tokenizer: str, kind: str = "whole", capacity: int = 4096, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    ``tokenizer`` is a file that executors can open; ``kind`` as in
    ``encoding.CachedEncoder``. A null or empty text is the end id alone. Only
    documents longer than ``capacity`` are cut. Rows repeated with one id are
    packed each by itself; ids may be null; an empty frame gives no rows.
    """
    kind_of_id = id_type(docs, id_col)
    schema = T.StructType([T.StructField("doc_id", kind_of_id), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
                           T.StructField("rank_in_part", T.LongType())])
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    with small_batches(docs.sparkSession):
        pieces = stored(texts.mapInArrow(_pieces(tokenizer, kind, end_id, capacity, to_arrow_type(kind_of_id)), schema),
                        "pack-pieces")

    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(base, ["length", "part"])
              .withColumn("rank", F.col("base") + F.col("rank_in_part")))

    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan_best_fit(counts, capacity)
    plan = local_rows(docs.sparkSession, slots, ["length", "first_rank", "number", "first_sequence", "offset"])
    fits = ((ranked["length"] == plan["length"]) & (ranked["rank"] >= plan["first_rank"])
            & (ranked["rank"] < plan["first_rank"] + plan["number"]))
    return ranked.join(plan, fits).select(
        "doc_id", "piece", "start", ranked["length"].alias("length"), "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
