"""Ranked lexical search by pipelined term partitioning.

The terms of the search items are dealt to owners, rarest first, each with an
equal share of the postings. A shard is a run of documents with the postings
of all owners. Bundles of items go from owner to owner: at each stage a cogroup
by (bundle, shard) brings the bundle's sparse document accumulators together
with the owner's postings, which add their integer contributions; then the
accumulators go on to the next owner. The last owner gives each item's best
documents of the shard, and those of all shards meet in a top-k by item.

An accumulator is dropped when even the most that later owners can add in its
shard leaves it behind as many documents as are asked for, so those that travel
are few although common terms occur nearly everywhere. Nothing that could be
among the best, ties included, is dropped.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import UPPER, arrow_rows, id_type, lower_ascii, slices, stored, text_of

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The bytes of terms, A-Z as a-z; all others as spaces.
_FOLD = bytes(b + 32 if chr(b) in UPPER else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

#: Pairs of item and term that one pass over the documents takes; an item of
#: more distinct terms is a pass of its own.
BLOCK_TERMS = 200_000
#: Items of a bundle, owners of terms, and bytes of text of a shard.
BUNDLE_ITEMS, OWNERS, SHARD_BYTES = 256, 4, 8 << 20


def _blob(numbers, dtype: str) -> bytes:
    return np.asarray(numbers, dtype).tobytes()


def _index(vocabulary: dict[bytes, int], shard_bytes: int, id_arrow: pa.DataType):
    fields = [pa.field("shard", pa.int64()), pa.field("with_terms", pa.int64()), pa.field("all_terms", pa.int64()),
              pa.field("doc_ids", pa.list_(id_arrow)), pa.field("doc_terms", pa.binary()), pa.field("terms", pa.binary()),
              pa.field("ends", pa.binary()), pa.field("docs", pa.binary()), pa.field("tfs", pa.binary())]

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, find = TaskContext.get().partitionId(), 0, vocabulary.get
        for batch in slices(batches, "text", shard_bytes):
            # in the order that breaks ties, so that a document's place in its shard does
            batch = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_end"))
            lengths, keys = [], []
            for place, text in enumerate(batch.column("text").cast(pa.binary())):
                terms = text.as_py().translate(_FOLD).split()
                lengths.append(len(terms))
                ids = np.fromiter(map(find, terms, repeat(-1)), np.int64, len(terms))
                keys.append(ids[ids >= 0] * batch.num_rows + place)
            key, tfs = np.unique(np.concatenate(keys), return_counts=True)
            owned, docs = np.divmod(key, batch.num_rows)
            terms, first = np.unique(owned, return_index=True)
            yield arrow_rows(fields, {k: [v] for k, v in {
                "shard": (part << 32) + number, "with_terms": sum(n > 0 for n in lengths), "all_terms": sum(lengths),
                "doc_ids": batch.column("doc_id").to_pylist(), "doc_terms": _blob(lengths, "<i8"),
                "terms": _blob(terms, "<i4"), "ends": _blob(np.append(first[1:], len(key)) if len(key) else [], "<i4"),
                "docs": _blob(docs, "<i4"), "tfs": _blob(tfs, "<i8")}.items()})
            number += 1

    return index


def _document_counts(size: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                df[np.frombuffer(row["terms"], "<i4")] += np.diff(np.frombuffer(row["ends"], "<i4"), prepend=0)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["term", "df"])

    return count


class _Block:
    """The items of one pass: each one's terms by number, their owners and
    weights. Its size is bounded by ``BLOCK_TERMS``, or by its one item."""

    def __init__(self, pairs: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        by_item: dict[int, list[int]] = defaultdict(list)
        for item, term in pairs:
            by_item[item].append(self.vocabulary.setdefault(term, len(self.vocabulary)))
        self.items = sorted(by_item)
        self.terms = [np.array(sorted(by_item[i]), np.int64) for i in self.items]
        self.bundle_items = BUNDLE_ITEMS
        self.bundles = -(-len(self.items) // BUNDLE_ITEMS)

    def weigh(self, df: dict[int, int], with_terms: int, owners: int) -> None:
        size = len(self.vocabulary)
        self.weight, self.owner = np.zeros(size, np.int64), np.zeros(size, np.int64)
        total, before = sum(df.values()), 0
        for term in sorted(df, key=lambda t: (df[t], t)):
            self.weight[term] = math.floor(1000 * math.log((2 * with_terms + 2) / (2 * df[term] + 1)))
            self.owner[term] = before * owners // total
            before += df[term]

    def bundle(self, number: int) -> range:
        return range(number * self.bundle_items, min(len(self.items), (number + 1) * self.bundle_items))


def _deal(block: _Block, owners: int, n_docs: int, n_terms: int, id_arrow: pa.DataType):
    """A shard's postings for each bundle and owner, with each term's factor
    and the most that later owners can add to each item here."""
    fields = [pa.field("bundle", pa.int32()), pa.field("shard", pa.int64()), pa.field("owner", pa.int32()),
              pa.field("n_docs", pa.int32()), pa.field("terms", pa.binary()), pa.field("ends", pa.binary()),
              pa.field("docs", pa.binary()), pa.field("factors", pa.binary()), pa.field("later", pa.binary()),
              pa.field("doc_ids", pa.list_(id_arrow))]

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from one(batch.slice(k, 1).to_pylist()[0])

    def one(row: dict) -> Iterator[pa.RecordBatch]:
        doc_terms = np.frombuffer(row["doc_terms"], "<i8").tolist()
        m = np.array([10 + 90 * n * n_docs // n_terms if n else 1 for n in doc_terms], np.int64)
        terms, ends = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["ends"], "<i4")
        docs, tfs = np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["tfs"], "<i8")
        factors = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[docs])
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        most = np.zeros(len(block.vocabulary), np.int64)
        if len(terms):
            most[terms] = block.weight[terms] * np.maximum.reduceat(factors, begins)
        for b in range(block.bundles):
            wanted = np.zeros(len(block.vocabulary), bool)
            for i in block.bundle(b):
                wanted[block.terms[i]] = True
            for o in range(owners):
                mine = np.flatnonzero(wanted[terms] & (block.owner[terms] == o))
                sizes = ends[mine] - begins[mine]
                at = np.repeat(begins[mine] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                later = [most[t[block.owner[t] > o]].sum() for t in map(block.terms.__getitem__, block.bundle(b))]
                yield arrow_rows(fields, {n: [v] for n, v in {
                    "bundle": b, "shard": row["shard"], "owner": o, "n_docs": len(doc_terms),
                    "terms": _blob(terms[mine], "<i4"), "ends": _blob(np.cumsum(sizes), "<i4"),
                    "docs": _blob(docs[at], "<i4"), "factors": _blob(factors[at], "<i4"), "later": _blob(later, "<i8"),
                    "doc_ids": row["doc_ids"] if o == owners - 1 else None}.items()})

    return deal


def _add(block: _Block, top: int, last: bool, id_arrow: pa.DataType):
    """One stage: an owner's contributions to a bundle's accumulators."""
    if last:
        fields = [pa.field("item", pa.int64()), pa.field("doc_id", id_arrow), pa.field("score", pa.int64())]
    else:
        fields = [pa.field("bundle", pa.int32()), pa.field("shard", pa.int64()), pa.field("ends", pa.binary()),
                  pa.field("docs", pa.binary()), pa.field("scores", pa.binary())]

    def add(key, carried: pa.Table, postings: pa.Table) -> pa.Table:
        bundle, shard = (k.as_py() for k in key)
        have, own = carried.to_pylist()[0], postings.to_pylist()[0]
        ends, docs = np.frombuffer(own["ends"], "<i4").tolist(), np.frombuffer(own["docs"], "<i4")
        factors, later = np.frombuffer(own["factors"], "<i4").astype(np.int64), np.frombuffer(own["later"], "<i8")
        lists = {t: slice(a, b) for t, a, b in zip(np.frombuffer(own["terms"], "<i4").tolist(), [0, *ends], ends)}
        had_docs, had = np.frombuffer(have["docs"], "<i4"), np.frombuffer(have["scores"], "<i8")
        had_ends = np.frombuffer(have["ends"], "<i4").tolist() or [0] * len(later)
        out_docs, out_scores, at = [], [], 0
        for i, end, more in zip(block.bundle(bundle), had_ends, later.tolist(), strict=True):
            total = np.zeros(own["n_docs"], np.int64)
            total[had_docs[at:end]] = had[at:end]
            at = end
            for t in block.terms[i].tolist():
                if t in lists:
                    total[docs[lists[t]]] += block.weight[t] * factors[lists[t]]
            found = np.flatnonzero(total)
            if len(found) > top:
                least = np.partition(total[found], len(found) - top)[len(found) - top]
                found = found[total[found] + more >= least]
            if last:  # best first; of equal ones the earlier place
                found = found[np.lexsort((found, -total[found]))][:top]
            out_docs.append(found)
            out_scores.append(total[found])
        sizes = list(map(len, out_docs))
        docs, scores = np.concatenate(out_docs), np.concatenate(out_scores)
        if last:
            items = np.repeat([block.items[i] for i in block.bundle(bundle)], sizes)
            ids = pa.array(own["doc_ids"], id_arrow).take(pa.array(docs, pa.int64()))
            return pa.Table.from_arrays([pa.array(items, pa.int64()), ids, pa.array(scores, pa.int64())],
                                        schema=pa.schema(fields))
        return pa.Table.from_batches([arrow_rows(fields, {n: [v] for n, v in {
            "bundle": bundle, "shard": shard, "ends": _blob(np.cumsum(sizes), "<i4"), "docs": _blob(docs, "<i4"),
            "scores": _blob(scores, "<i8")}.items()})])

    return add


def _search_block(texts: DataFrame, pairs: list[tuple[int, bytes]], top: int, owners: int) -> DataFrame:
    """(item, doc_id, score): each item's best documents of each shard."""
    kind = texts.schema["doc_id"].dataType
    arrow, name = to_arrow_type(kind), kind.simpleString()
    block = _Block(pairs)
    index = stored(texts.mapInArrow(
        _index(block.vocabulary, SHARD_BYTES, arrow), f"shard long, with_terms long, all_terms long, doc_ids array<{name}>, "
        "doc_terms binary, terms binary, ends binary, docs binary, tfs binary"), "search-index")
    facts = index.agg(F.sum("with_terms").alias("n"), F.sum("all_terms").alias("l")).first()
    counts = (index.select("terms", "ends").mapInArrow(_document_counts(len(block.vocabulary)), "term int, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect())  # one row a term of the block
    block.weigh({r["term"]: r["df"] for r in counts}, facts["n"] or 0, owners)
    dealt = index.mapInArrow(
        _deal(block, owners, facts["n"] or 0, facts["l"] or 1, arrow),
        "bundle int, shard long, owner int, n_docs int, terms binary, ends binary, docs binary, factors binary, "
        f"later binary, doc_ids array<{name}>")
    dealt = stored(dealt, "search-dealt")
    nothing = F.lit(b"")
    state = index.select(F.explode(F.sequence(F.lit(0), F.lit(block.bundles - 1))).alias("bundle"), "shard",
                         nothing.alias("ends"), nothing.alias("docs"), nothing.alias("scores"))
    for o in range(owners):
        last = o == owners - 1
        own = dealt.where(F.col("owner") == o).select("bundle", "shard", "n_docs", "terms", "ends", "docs", "factors",
                                                      "later", *(["doc_ids"] if last else []))
        schema = (f"item long, doc_id {name}, score long" if last else
                  "bundle int, shard long, ends binary, docs binary, scores binary")
        state = (state.groupBy("bundle", "shard").cogroup(own.groupBy("bundle", "shard"))
                 .applyInArrow(_add(block, top, last, arrow), schema))
    return state


def search(docs: DataFrame, items: DataFrame, top: int = 10, owners: int = OWNERS, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents with
    a score above 0, equal scores by ascending doc_id (nulls last).

    With N documents that hold a term, L terms in all, n a document's terms,
    df the documents that hold a term and tf its occurrences in one, a term
    weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))), and a document scores the
    sum of w ((10^9 tf) div (1000 tf + 8 m)), m = 10 + (90 n N) div L, over the
    distinct terms of the item. A null or empty text has no terms: such items
    give no rows, such documents are never found. Rows repeated with one id,
    of either table, count each by itself; ids may be null; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    kind = id_type(docs, id_col)
    listed = stored(items.select(F.col(item_col).alias("item_id"), text_of(items, item_text_col).alias("text"))
                    .withColumn("item", F.monotonically_increasing_id()), "search-items")
    pairs = stored(listed.select("item", F.explode(F.array_distinct(
        F.regexp_extract_all(lower_ascii("text"), F.lit(TERM), F.lit(0)))).alias("term")), "search-terms")
    blocks = -(-pairs.count() // BLOCK_TERMS)
    if not blocks:
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", listed.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", kind), T.StructField("score", T.LongType())]))
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    found = []
    for b in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item", "term")
        some = [(r["item"], r["term"].encode()) for r in mine.collect()]  # BLOCK_TERMS rows, or one item's
        if some:
            found.append(_search_block(texts, some, top, owners))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = (reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best))
              .where(F.col("rank") <= top))
    return ranked.join(listed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
