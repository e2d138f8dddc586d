"""Benchmark decontamination in DataFrame functions only.

A document is contaminated by a benchmark item if one of its item-sized
windows of word shingles has a weighted similarity of ``similarity`` or more
with the item's (multiset Jaccard: shingles weigh as often as they occur).

The benchmark is the query set; it is taken in blocks. Such a window must hold
a certain number of the item's shingles, so shingles of the block's items are
looked up in every document, and windows that hold enough of them become
candidates (nothing that could reach the similarity is left out). A candidate
window gets a SimHash over its shingles (sums over its exploded hashes, so the
work grows with its length alone), and its 64 bits in ``max_bits`` + 1 blocks meet the items' blocks: within ``max_bits`` bits one block at least is
equal. What is within the radius is verified by the exact similarity. The
radius holds for shingles that occur once; where one occurs more often in the
item or the window, or the window is shorter than the item, few shingles may
turn many bits, and the pair is verified whatever its bits are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, no_rows, stored, text_of, whole_rows
from .licenses import words_column

#: Shingles of items that are looked up in one pass over the documents.
SHINGLES_A_BLOCK = 50_000
#: Window starts that one piece of a document's hashes serves: a long document
#: is many pieces, so its windows are cut from short arrays, on many tasks.
STARTS_A_PIECE = 1_024
BITS = 64
HALF = BITS // 2


def with_shingles(df: DataFrame, text, size: int) -> DataFrame:
    """Adds hs: hashes of all runs of ``size`` words, repeats included. Fewer
    words: their whole sequence is one shingle; no words: none."""
    hashes = F.transform(words_column(text), lambda w: F.xxhash64(w))
    runs = lambda wh: F.transform(F.sequence(F.lit(0), F.size(wh) - size),
                                  lambda i: F.xxhash64(*(F.get(wh, i + k) for k in range(size))))
    whole = lambda wh: F.array(F.xxhash64(F.concat_ws(" ", F.transform(wh, lambda h: h.cast("string")))))
    return df.withColumn("hs", let(hashes, lambda wh: F.when(F.size(wh) >= size, runs(wh))
                                   .when(F.size(wh) > 0, whole(wh)).otherwise(F.array().cast("array<long>"))))


def block_values(fp, max_bits: int) -> list:
    """The fingerprint's bits in ``max_bits`` + 1 blocks."""
    edges = [BITS * k // (max_bits + 1) for k in range(max_bits + 2)]
    return [F.call_function("shiftrightunsigned", fp, F.lit(a)).bitwiseAND(F.lit((1 << (b - a)) - 1))
            for a, b in zip(edges, edges[1:], strict=False)]


def bit_blocks(fp, max_bits: int):
    """Array of (block, value)."""
    return F.array(*(F.struct(F.lit(k).alias("block"), v.alias("value")) for k, v in enumerate(block_values(fp, max_bits))))


def first_equal_block(difference, max_bits: int):
    """The lowest block in which two fingerprints agree, from their XOR."""
    return F.coalesce(*(F.when(v == 0, F.lit(k)) for k, v in enumerate(block_values(difference, max_bits))))


def repeats(hs):
    return F.size(F.array_distinct(hs)) < F.size(hs)


def needed(window, item, similarity: float):
    """Shared shingles without which ``similarity`` cannot be reached."""
    return F.ceil((window + item) * (similarity / (1 + similarity)) - 1e-9)


def shared(window, item, often):
    """Size of the multiset intersection of a window and an item, of which
    ``often`` lists the hashes that it holds more than once."""
    again = F.aggregate(often, F.lit(0).cast("long"), lambda acc, o: acc + F.greatest(F.lit(0), F.least(
        o["times"], F.size(F.filter(window, lambda x: x == o["h"]))) - 1))
    return F.size(F.array_intersect(window, item)) + again


def bit_sums(h):
    """Aggregates m0 .. m31: in how many hashes bit k is set, and in the upper
    half of the same number bit k + 32."""
    return [F.sum(F.call_function("shiftrightunsigned", h, F.lit(k)).bitwiseAND(F.lit((1 << HALF) | 1))).alias(f"m{k}")
            for k in range(HALF)]


def bits_over(size):
    """The fingerprint from ``bit_sums``: bits set in over half of ``size`` hashes."""
    low = [F.col(f"m{k}").bitwiseAND(F.lit((1 << HALF) - 1)) for k in range(HALF)]
    high = [F.call_function("shiftrightunsigned", F.col(f"m{k}"), F.lit(HALF)) for k in range(HALF)]
    whole = F.lit(0).cast("long")
    for k, n in enumerate(low + high):
        whole = whole.bitwiseOR(F.when(n * 2 > size, F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(k)))
                                .otherwise(F.lit(0).cast("long")))
    return whole


def benchmark_blocks(benchmark: DataFrame, item_id: str, item_text: str, shingle: int) -> DataFrame:
    """item_no, item_id, hs, n, often, fp and the block of items it is looked up in."""
    items = (with_shingles(benchmark.select(F.col(item_id).alias("item_id"), text_of(benchmark, item_text).alias("t")),
                           F.col("t"), shingle).drop("t").where(F.size("hs") > 0)
             .withColumn("n", F.size("hs")).withColumn("item_no", F.monotonically_increasing_id()))
    items = stored(items, "benchmark-items")
    # Sizes are added up within a few groups of items, not over one sorted list.
    lanes = items.withColumn("lane", F.pmod(F.xxhash64("item_no"), F.lit(max(1, -(-items.count() // 10_000)))))
    so_far = Window.partitionBy("lane").orderBy("item_no").rowsBetween(Window.unboundedPreceding, 0)
    blocks = lanes.withColumn("block_no", F.struct("lane", F.floor(F.sum("n").over(so_far) / SHINGLES_A_BLOCK).alias("k"))
                              ).drop("lane")
    prints = (items.select("item_no", "n", F.explode("hs").alias("h")).groupBy("item_no", "n").agg(*bit_sums(F.col("h")))
              .select("item_no", bits_over(F.col("n")).alias("fp")))
    often = (items.select("item_no", F.explode("hs").alias("h")).groupBy("item_no", "h").agg(F.count("*").alias("times"))
             .where("times > 1").groupBy("item_no").agg(F.collect_list(F.struct("h", "times")).alias("often")))
    none = F.array().cast("array<struct<h:bigint,times:bigint>>")
    return (blocks.join(prints, "item_no").join(often, "item_no", "left")
            .withColumn("often", F.coalesce("often", none)))


def find_contamination(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, similarity: float = 0.8,
                       max_bits: int = 23, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs`` and benchmark item that contaminates it:
    doc_id, text_key (hash of the text), item_id, similarity (the best
    window's), bits (its SimHash distance) and start_word.

    Words are as in ``licenses``: letters and digits, A-Z lower-cased. A
    document shorter than the item is one window. Null or empty texts, of
    documents or items, have no shingles and match nothing. Items repeated
    under several ids are all reported, rows repeated in ``docs`` each by
    itself; ids may be null; other columns are not read; if either frame is
    empty there are no rows.
    """
    items = stored(benchmark_blocks(benchmark, item_id, item_text, shingle), "benchmark-blocks")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("t"))
    texts = (with_shingles(texts, F.col("t"), shingle)
             .select("doc_id", F.xxhash64("t").alias("text_key"), "hs"))
    found = no_rows(docs.sparkSession, T.StructType([
        texts.schema["doc_id"], T.StructField("text_key", T.LongType()), items.schema["item_id"],
        T.StructField("similarity", T.DoubleType()), T.StructField("bits", T.IntegerType()),
        T.StructField("start_word", T.IntegerType())]))
    for row in items.select("block_no").distinct().collect():
        block = items.where((F.col("block_no.lane") == row["block_no"]["lane"])
                            & (F.col("block_no.k") == row["block_no"]["k"])).drop("block_no")
        found = found.unionByName(_search(texts, block, similarity, max_bits))
    return found


def _search(texts: DataFrame, items: DataFrame, similarity: float, max_bits: int) -> DataFrame:
    """One block of items (``SHINGLES_A_BLOCK`` shingles, and one item more,
    bound all that is broadcast here) against all documents."""
    wanted = [r[0] for r in items.select(F.explode("hs")).distinct().collect()]
    least = items.agg(F.min(needed(F.lit(1), F.col("n"), similarity))).first()[0]
    # As SQL text: one literal list, which Spark turns into a hash set.
    hits = F.expr("transform(array(hs), a -> if(size(a) > 0, filter(sequence(0, size(a) - 1), i -> a[i] in "
                  f"({','.join(f'{h}L' for h in wanted)})), array()))[0]")
    held = (texts.withColumn("hits", hits).where(F.size("hits") >= least)
            .withColumn("row", F.monotonically_increasing_id()))
    held = stored(held, "decontaminate-held")
    longest = items.agg(F.max("n")).first()[0]
    pieces = stored(held.select("row", "doc_id", "text_key", "hs", F.explode(F.sequence(
        F.lit(0), F.floor((F.size("hs") - 1) / STARTS_A_PIECE).cast("int"))).alias("piece"))
        .withColumn("hs", F.slice("hs", F.col("piece") * STARTS_A_PIECE + 1, STARTS_A_PIECE + longest - 1)),
        "decontaminate-pieces")

    postings = items.select("item_no", "n", repeats(F.col("hs")).alias("heavy"), F.explode(F.array_distinct("hs")).alias("h"))
    pairs = (held.select("row", F.size("hs").alias("size"), F.explode("hits").alias("p"), "hs")
             .select("row", "size", "p", F.get("hs", F.col("p")).alias("h"))
             .join(F.broadcast(postings), "h").groupBy("row", "size", "item_no", "n", "heavy")
             .agg(F.sort_array(F.collect_list("p")).alias("ps")))
    window = F.least("size", "n")
    need = needed(window, F.col("n"), similarity).cast("int")
    last = F.col("size") - window
    # A window moved right to its first hit keeps all its hits, so windows
    # that start at a hit, and the last one, are enough.
    at_hits = F.filter(F.transform("ps", lambda p, j: F.when(
        (p <= last) & (F.get("ps", j + need - 1) < p + window), p)), lambda s: s.isNotNull())
    at_end = F.when(F.get("ps", F.size("ps") - need) >= last, F.array(last)).otherwise(F.array().cast("array<int>"))
    starts = stored(pairs.where(F.size("ps") >= need).select(
        "row", "n", "item_no", "heavy", window.alias("w"), F.explode(F.array_union(at_hits, at_end)).alias("s")),
        "decontaminate-starts")

    place = ["row", "n", "w", "s"]
    at_piece = F.floor(F.col("s") / STARTS_A_PIECE).cast("int").alias("piece")
    inside = F.slice("hs", F.col("s") - F.col("piece") * STARTS_A_PIECE + 1, F.col("w"))
    hashes = (starts.select(*place, at_piece).distinct().join(pieces.select("row", "piece", "hs"), ["row", "piece"])
              .select(*place, inside.alias("win"))
              .withColumn("loose", repeats(F.col("win")) | (F.col("w") < F.col("n")))
              .select(*place, "loose", F.explode("win").alias("h")))
    windows = stored(hashes.groupBy(*place, "loose").agg(*bit_sums(F.col("h")))
                     .select(*place, "loose", bits_over(F.col("w")).alias("wfp")), "decontaminate-windows")

    indexed = items.select("item_no", F.col("n").alias("item_n"), "fp", F.explode(bit_blocks(F.col("fp"), max_bits)).alias("ib"))
    near = (windows.select(*place, "wfp", F.explode(bit_blocks(F.col("wfp"), max_bits)).alias("wb"))
            .join(F.broadcast(indexed), (F.col("n") == F.col("item_n")) & (F.col("wb.block") == F.col("ib.block"))
                  & (F.col("wb.value") == F.col("ib.value")))
            .withColumn("x", F.col("wfp").bitwiseXOR(F.col("fp"))).withColumn("bits", F.bit_count("x"))
            .where(F.col("bits") <= max_bits).where(first_equal_block(F.col("x"), max_bits) == F.col("wb.block"))
            .select("row", "w", "s", "item_no", "bits"))
    direct = (starts.join(windows, place).where(F.col("heavy") | F.col("loose"))
              .join(F.broadcast(items.select("item_no", "fp")), "item_no")
              .select("row", "w", "s", "item_no", F.bit_count(F.col("wfp").bitwiseXOR(F.col("fp"))).alias("bits")))
    candidates = stored(near.unionByName(direct).distinct(), "decontaminate-candidates")

    verified = (candidates.select("*", at_piece).join(pieces, ["row", "piece"])
                .select("row", "item_no", "doc_id", "text_key", "bits", "s", F.col("w").alias("size"), inside.alias("win"))
                .join(F.broadcast(items.select("item_no", "item_id", "n", F.col("hs").alias("ihs"), "often")), "item_no")
                .withColumn("both", shared(F.col("win"), F.col("ihs"), F.col("often"))))
    return (verified.withColumn("similarity", F.col("both") / (F.col("size") + F.col("n") - F.col("both")))
            .where(F.col("similarity") >= similarity)
            .groupBy("row", "item_no")
            .agg(F.max(F.struct("similarity", -F.col("bits"), -F.col("s"))).alias("best"),
                 *(F.first(c).alias(c) for c in ("doc_id", "text_key", "item_id")))
            .select("doc_id", "text_key", "item_id", F.col("best.similarity").alias("similarity"),
                    (-F.col("best.col2")).alias("bits"), (-F.col("best.col3")).alias("start_word")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with all
    their columns, whatever these are called.

    Null or empty texts match nothing and stay. Null ids are judged like any
    other. Rows repeated with one id and text go or stay together; of rows with
    one id and different texts only those with a contaminated text go. An empty
    benchmark leaves all rows, an empty frame none.
    """
    found = stored(find_contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options), "contaminated")
    out = found.select(F.col("doc_id").alias("out_id"), F.col("text_key").alias("out_key")).distinct()
    rows = whole_rows(docs, id_col, F.xxhash64(text_of(docs, text_col)))
    same = F.col("id").eqNullSafe(F.col("out_id")) & (F.col("key") == F.col("out_key"))
    return rows.join(out, same, "left_anti").select("whole.*")
