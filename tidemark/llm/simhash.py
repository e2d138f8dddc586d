"""SimHash near-duplicates by a binary trie joined with itself.

Fingerprints differ in at most ``max_bits`` bits when they are linked. The
distinct fingerprints form a binary trie; node pairs are traversed together,
bit by bit: a pair goes on to its four child pairs with the bits that differ
added up, and is pruned once they exceed the budget.

The top of a full trie prunes nothing, so the traversal is dealt out: the 64
bits are cut into blocks, and of two linked fingerprints all blocks but
``max_bits`` agree at least. For each choice of agreeing blocks a copy of the
trie has those blocks on top, with no error allowed in them; only nodes below
the same top are paired. Blocks are chosen so that a top is shared by few
fingerprints. Tops that more fingerprints share than one task should hold are
dealt again with smaller blocks.

Each task joins what it links into one star per linked set, so that a group
of copies gives as many edges as it has fingerprints, not its square. Stars
are connected over the whole corpus with large-star and small-star steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, id_type, no_rows, slices, small_batches, stored, text_of, whole_rows

BITS = 64
SEED = 42
#: Fingerprints below one top that a task pairs; more are dealt again.
TOP_MOST = 20_000
#: Fingerprints that one traversal takes together.
ROWS_A_STEP = 100_000
#: Shingles whose bits are counted at a time.
SHINGLES_A_STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = 4, seed: int = SEED) -> int:
    """SimHash of the lower-cased (A-Z) text's word shingles, repeats
    included. Fewer words than a shingle has: their whole sequence is one. No
    word: zero."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    last = max(len(words) - shingle, 0)
    begins, ends = begins[:last + 1], ends[len(words) - 1 - last:]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, last + 1, SHINGLES_A_STEP):
        cuts = map(slice, begins[k:k + SHINGLES_A_STEP].tolist(), ends[k:k + SHINGLES_A_STEP].tolist())
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(seed)), np.dtype("<u8"))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > last + 1, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (hash of the text, to tell rows of one id apart) and
    fp (the fingerprint's 64 bits as a signed long), for each row."""
    kind = id_type(docs, id_col)
    id_arrow = to_arrow_type(kind)
    fields = [pa.field("doc_id", id_arrow), pa.field("text_key", pa.int64()), pa.field("fp", pa.int64())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fps)], schema=pa.schema(fields))

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("text_key", T.LongType()),
                           T.StructField("fp", T.LongType())])
    return (docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
            .withColumn("text_key", F.xxhash64("text")).select("doc_id", "text_key", "text").mapInArrow(run, schema))


def trie_pairs(group: np.ndarray, key: np.ndarray, first_bit: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Link every linked set within each group: (member, root) positions.

    ``key`` (unsigned) is sorted within ascending ``group`` and has no repeats
    there; bits before ``first_bit`` (from the highest) agree in a group. The
    traversal runs with budgets 0, 1, .. ``max_bits``; pairs of nodes that an
    earlier one has already joined into one set are not followed again."""
    n = len(key)
    root = np.arange(n)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], n]
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    for budget in range(1, max_bits + 1):
        if not len(starts):
            break
        changes = np.r_[0, np.cumsum(root[1:] != root[:-1])]
        a, b, c, d = starts, ends, starts, ends  # node pairs: [a, b) with [c, d)
        err = np.zeros(len(a), np.int64)
        for bit in range(first_bit, BITS):
            if not len(a):
                break
            zero = np.r_[0, np.cumsum((key >> np.uint64(BITS - 1 - bit)) & np.uint64(1) == 0)]
            m, o = a + zero[b] - zero[a], c + zero[d] - zero[c]
            same = a == c
            other = ~same
            a, b, c, d, err = (np.concatenate(x) for x in zip(
                (a, m, c, o, err), (m, b, o, d, err), (a, m, o, d, err + 1),
                (m[other], b[other], c[other], o[other], err[other] + 1), strict=True))
            keep = (err <= budget) & (b > a) & (d > c) & ((a != c) | (b - a > 1))
            a, b, c, d, err = (x[keep] for x in (a, b, c, d, err))
            one = (changes[b - 1] == changes[a]) & (changes[d - 1] == changes[c]) & (root[a] == root[c])
            a, b, c, d, err = (x[~one] for x in (a, b, c, d, err))
        root = _joined(root, a, c)
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def _joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sets after the pairs (x, y) are joined; a set's root is its least position."""
    root = root.copy()
    while True:
        rx, ry = root[x], root[y]
        apart = rx != ry
        if not apart.any():
            return root
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while not np.array_equal(shorter := root[root], root):
            root = shorter


def _blocks(number: int) -> list[tuple[int, int]]:
    """(first bit from the highest, width) of the blocks."""
    edges = [BITS * k // number for k in range(number + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _orders(number: int, max_bits: int) -> list[list[int]]:
    """For each trie: its blocks in order, those that must agree first."""
    tops = combinations(range(number), number - max_bits)
    return [[*top, *(k for k in range(number) if k not in top)] for top in tops]


def _permuted(fps: np.ndarray, blocks: list[tuple[int, int]], order: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for k in order:
        first, width = blocks[k]
        part = (fps >> np.uint64(BITS - first - width)) & np.uint64((1 << width) - 1)
        out = (out << np.uint64(width)) | part
    return out


def _restored(keys: np.ndarray, blocks: list[tuple[int, int]], order: list[int]) -> np.ndarray:
    out, left = np.zeros(len(keys), np.uint64), BITS
    for k in order:
        first, width = blocks[k]
        left -= width
        part = (keys >> np.uint64(left)) & np.uint64((1 << width) - 1)
        out |= part << np.uint64(BITS - first - width)
    return out


def _dealt(fps: DataFrame, number: int, max_bits: int) -> DataFrame:
    """A row (trie, top, key) for each fingerprint and trie: the bits that
    must agree, and the fingerprint's bits in the trie's order."""
    blocks, orders = _blocks(number), _orders(number, max_bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch.column("fp").to_pylist(), np.int64).view(np.uint64)
            for trie, order in enumerate(orders):
                keys = _permuted(values, blocks, order)
                width = sum(blocks[k][1] for k in order[:number - max_bits])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), trie, np.int32)),
                     pa.array((keys >> np.uint64(BITS - width)).view(np.int64)), pa.array(keys.view(np.int64))],
                    names=["trie", "top", "key"])

    return fps.mapInArrow(run, "trie int, top long, key long")


def _stars(number: int, max_bits: int):
    blocks, orders = _blocks(number), _orders(number, max_bits)
    fields = [pa.field("a", pa.int64()), pa.field("b", pa.int64())]

    def link(trie: np.ndarray, top: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        for t in np.unique(trie).tolist():
            own, order = trie == t, orders[t]
            keys = key[own]
            width = sum(blocks[k][1] for k in order[:number - max_bits])
            member, root = trie_pairs(top[own], keys, width, max_bits)
            if len(member):
                a, b = (_restored(keys[x], blocks, order).view(np.int64) for x in (member, root))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=pa.schema(fields))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by trie and top; a step ends between two tops."""
        held = []
        rows = 0

        def columns():
            trie, top, key = (np.concatenate([h[k] for h in held]) for k in range(3))
            order = np.lexsort((key, top, trie))
            return trie[order], top[order], key[order]

        for batch in batches:
            held.append((np.array(batch.column("trie")), np.array(batch.column("top")),
                         np.array(batch.column("key")).view(np.uint64)))
            rows += batch.num_rows
            if rows < ROWS_A_STEP:
                continue
            trie, top, key = columns()
            cut = np.flatnonzero((trie[1:] != trie[:-1]) | (top[1:] != top[:-1]))
            if len(cut):
                cut = cut[-1] + 1
                yield from link(trie[:cut], top[:cut], key[:cut])
                trie, top, key = trie[cut:], top[cut:], key[cut:]
            held, rows = [(trie, top, key)], len(key)
        if rows:
            yield from link(*columns())

    return run


def linked_fingerprints(fps: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp), as stars: two
    fingerprints are connected through edges exactly when they are through
    links of at most ``max_bits`` bits."""
    spark = fps.sparkSession
    edges = no_rows(spark, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    left = fps
    number = max_bits + 1
    count = left.count()
    if count < 2 or max_bits < 1:
        return edges
    while number < BITS // 4 and BITS * (number - max_bits) // number < math.log2(count):
        number += 1
    while True:
        dealt = _dealt(left, number, max_bits)
        last = number >= BITS // 4
        if not last:
            crowded = (dealt.groupBy("trie", "top").count().where(F.col("count") > TOP_MOST)
                       .select("trie", "top"))
            crowded = stored(crowded, "simhash-crowded")
            last = crowded.isEmpty()
        if last:
            few = dealt
        else:
            dealt = stored(dealt, "simhash-dealt")
            few = dealt.join(crowded, ["trie", "top"], "left_anti")
        # the same session-wide number of partitions as a join would take
        found = (few.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "trie", "top")
                 .sortWithinPartitions("trie", "top").mapInArrow(_stars(number, max_bits), "a long, b long"))
        edges = edges.unionByName(stored(found, "simhash-edges"))
        if last:
            return edges
        many = dealt.join(crowded, ["trie", "top"], "left_semi")
        left = stored(_back(many, number, max_bits).distinct(), "simhash-left")
        number = min(number + 3, BITS // 4)


def _back(dealt: DataFrame, number: int, max_bits: int) -> DataFrame:
    blocks, orders = _blocks(number), _orders(number, max_bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trie = np.array(batch.column("trie"))
            key = np.array(batch.column("key")).view(np.uint64)
            out = np.zeros(len(key), np.uint64)
            for t in np.unique(trie).tolist():
                out[trie == t] = _restored(key[trie == t], blocks, orders[t])
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["fp"])

    return dealt.mapInArrow(run, "fp long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the
    least node of its component. Alternating large-star and small-star steps;
    each step's edges are written to the shared folder."""
    edges = stored(_small_star(_large_star(edges.where("a <> b"))), "stars")
    before = None
    while (now := edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != before:
        before = now
        edges = stored(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are joined to its least neighbour or itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are joined to the least."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def near_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (a hash of the text),
    fingerprint (16 hex digits), component_id, the smallest doc_id that links
    of at most ``max_bits`` bits reach, and root, the component's least
    fingerprint as a signed number.

    A null text counts as empty; texts without words share fingerprint zero
    and are linked like any other. Null ids are passed over when the smallest
    is taken (a component of null ids alone has a null component_id). Repeated
    rows have one fingerprint and so one component. Only the id and text
    columns are read; an empty frame gives an empty result.
    """
    with small_batches(docs.sparkSession):
        docs_fp = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    by_fp = stored(docs_fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    stars = components(linked_fingerprints(by_fp.select("fp"), max_bits))
    rooted = by_fp.join(stars, by_fp["fp"] == stars["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    reach = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = rooted.join(reach, "root").select("fp", "root", "component_id")
    return (docs_fp.join(groups, "fp")
            .select("doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "root"))


def drop_near(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these
    are called: of every component the row with the smallest id (of rows with
    that id the one with the smallest text hash, once). Null texts count as
    empty and are linked like any other; a row with a null id stays only where
    its component has no other. An empty frame stays empty."""
    groups = near_groups(docs, shingle, max_bits, id_col, text_col)
    stay = (groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.first("component_id").alias("stay_id"), F.min("text_key").alias("stay_key"))
            .drop("root"))
    rows = whole_rows(docs, id_col, F.xxhash64(text_of(docs, text_col)))
    same = F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("key") == F.col("stay_key"))
    return rows.join(stay, same, "left_semi").dropDuplicates(["id", "key"]).select("whole.*")
