"""Phrase collocations by mergeable Misra-Gries summaries.

First pass: the n-grams of 1 to 5 words of each run of documents are counted
by 64-bit codes (of words and language), which hash partitions share out. A
partition merges the counts of all runs into one Misra-Gries summary: when it
holds more counters than its capacity, the largest count beyond the capacity is
taken from all of them and those at nothing go. With a capacity above the
partition's mass divided by the threshold, less than the threshold is ever
taken from a counter, so every n-gram that is frequent enough survives. Those
whose counter and what was taken together stay below the threshold go too.

Second pass: the words are walked again and the survivors' occurrences are
counted exactly, by their words. The survivors reach the tasks as a bit filter
of a fixed size: what passes it by chance is counted as well and found to be
rare. The filter's size changes how much is counted, never a result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, arrow_rows, partitions_for, slices, small_batches, stored, text_of

LONGEST = 5
UNDETERMINED = "und"

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(b + 32 if chr(b) in UPPER else 10 if b in _BREAKS else 32 if b == 9 else b for b in range(256))
_BREAK = b"\n"

#: Bytes of text whose n-grams are counted together.
RUN_BYTES = 3 << 20
#: Bytes of words that a worker keeps numbered.
VOCABULARY_BYTES = 32 << 20
#: Bytes of documents a hash partition of the summaries stands for.
PARTITION_BYTES = 1 << 20
#: Bits of the filter of survivors (a broadcast of an eighth of as many bytes).
FILTER_BITS = 1 << 26

#: Phrases that a task counts before it passes them on.
HELD_PHRASES = 150_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    """Numbers of words, from 1 on in the order they are met; 0 is a border
    of pieces. Emptied between runs when it has grown too large."""

    def __init__(self):
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.update({_BREAK: 0, b"": -1})
        self.words, self.codes, self.held = [b""], [0], 0

    def __missing__(self, word: bytes) -> int:
        number = len(self.words)
        self[word] = number
        self.words.append(word)
        self.codes.append(xxhash.xxh3_64_intdigest(word))
        self.held += 200 + len(word)
        return number


def _walk(batch: pa.RecordBatch, words: _Words) -> Iterator[tuple[str, np.ndarray]]:
    """The word numbers of a run's documents, per language."""
    if words.held > VOCABULARY_BYTES:
        words.empty()
    langs = batch.column("lang").to_pylist()
    texts = batch.column("text").cast(pa.binary())
    for lang in sorted(set(langs)):
        found = []
        for text, own in zip(texts, langs, strict=True):
            if own == lang:
                parts = (text.as_py().translate(_FOLD) + _BREAK).replace(_BREAK, b" \n ").split(b" ")
                numbers = np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))
                found.append(numbers[numbers >= 0])
        yield lang, np.concatenate(found)


def _codes(lang: str, numbers: np.ndarray, words: _Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: where such n-grams begin, and their codes."""
    own = np.array(words.codes, np.uint64)[numbers]
    code = (own ^ np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))) * _MIX
    at = np.flatnonzero(numbers)
    code = code[at]
    for k in range(1, LONGEST + 1):
        if k > 1:
            more = at + k - 1 < len(numbers)
            more[more] = numbers[at[more] + k - 1] > 0
            at, code = at[more], code[more]
            code = (code ^ (code >> np.uint64(29)) ^ own[at + k - 1]) * _STEP + np.uint64(k)
            code = (code ^ (code >> np.uint64(32))) * _MIX
        yield at, code ^ (code >> np.uint64(31))


def _squeeze(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending 32-bit codes with their counts, compressed: the codes as
    differences, byte by byte."""
    steps = np.diff(codes, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    most = "<u8" if counts.max(initial=0) > 255 else "u1"
    return zstandard.compress(len(codes).to_bytes(8, "little") + bytes([counts.dtype.itemsize if most == "<u8" else 1])
                              + np.ascontiguousarray(steps).tobytes() + counts.astype(most).tobytes(), 1)


def _spread(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(blob)
    n, width = int.from_bytes(raw[:8], "little"), raw[8]
    steps = np.frombuffer(raw, np.uint8, 4 * n, 9).reshape(4, n).T
    codes = np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel(), dtype=np.uint32)
    counts = np.frombuffer(raw, "u1" if width == 1 else "<u8", n, 9 + 4 * n)
    return codes, counts.astype(np.int64)


def _summarise(bits: int):
    """First pass, by runs: the counts of each hash partition's codes, and the
    words of each language."""
    fields = [pa.field("lang", pa.string()), pa.field("hp", pa.int32()), pa.field("n", pa.int64()),
              pa.field("blob", pa.binary())]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), Counter()
        for batch in _runs(slices(batches, "text")):
            found = []
            for lang, numbers in _walk(batch, words):
                seen[lang] += int(np.count_nonzero(numbers))
                found += [code for _, code in _codes(lang, numbers, words)]
            codes = np.concatenate(found)
            found.clear()
            codes.sort()
            first = np.flatnonzero(np.diff(codes, prepend=codes[:1] ^ np.uint64(1)))
            codes, counts = codes[first], np.diff(first, append=len(codes))
            ends = np.searchsorted(codes >> np.uint64(64 - bits), np.arange(1 << bits), "right")
            codes = (codes >> np.uint64(32 - bits)).astype(np.uint32)
            for hp, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                if a < b:
                    # codes that the cut has made equal are one
                    own, first = np.unique(codes[a:b], return_index=True)
                    sums = np.add.reduceat(counts[a:b], first)
                    yield arrow_rows(fields, {"lang": [None], "hp": [hp], "n": [int(sums.sum())],
                                              "blob": [_squeeze(own, sums)]})
        yield arrow_rows(fields, {"lang": list(seen), "hp": [None] * len(seen), "n": list(seen.values()),
                                  "blob": [None] * len(seen)})

    return count


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together to runs, so that what repeats in a task is
    counted before it leaves it."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= RUN_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class MisraGries:
    """A mergeable summary: ascending codes, their counters, and how much was
    taken from each counter so far, which is how far any is below its count."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.codes, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        codes = np.concatenate([self.codes, *(c for c, _ in parts)])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], np.concatenate([self.counts, *(n for _, n in parts)])[order]
        first = np.flatnonzero(np.diff(codes, prepend=codes[:1] ^ np.uint32(1))) if len(codes) else []
        if len(codes):
            codes, counts = codes[first], np.add.reduceat(counts, first)
        if len(codes) > self.capacity:
            most = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            self.taken += int(most)
            counts = counts - most
            codes, counts = codes[counts > 0], counts[counts > 0]
        self.codes, self.counts = codes, counts


def _survivors(threshold: int):
    """A hash partition's summary over all runs: the codes that may be
    frequent enough."""
    def merge(key: tuple[pa.Scalar, ...], runs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, parts, held = None, [], 0
        for batch in runs:
            summary = summary or MisraGries(batch.column("mass")[0].as_py() // threshold + 1)
            for blob in batch.column("blob"):
                parts.append(_spread(blob.as_py()))
                held += len(parts[-1][0])
                if held > max(summary.capacity, 1 << 18):
                    summary.merge(parts)
                    parts, held = [], 0
        summary.merge(parts)
        assert summary.taken < threshold
        codes = summary.codes[summary.counts + summary.taken >= threshold]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), key[0].as_py()), pa.int32()),
                                          pa.array(codes, pa.int64())], ["hp", "code"])

    return merge


def _places(hp, code, bits: int, size: int):
    """Two places in the filter for a code of a hash partition (the part of
    the 64-bit code that the first pass keeps)."""
    whole = (hp.astype(np.uint64) << np.uint64(32)) | code.astype(np.uint64)
    mixed = whole * _STEP
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    return (mixed >> np.uint64(33)) % np.uint64(size), (mixed & np.uint64(0xFFFFFFFF)) % np.uint64(size)


def _filter_words(bits: int, size: int):
    """The filter of a task's survivors, as numbered 64-bit words."""
    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(size, bool)
        for batch in batches:
            hp, code = (np.array(batch.column(c)) for c in ("hp", "code"))
            for place in _places(hp, code, bits, size):
                mine[place.astype(np.int64)] = True
        own = np.packbits(mine, bitorder="little").view("<i8")
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(own[at], pa.int64())], ["at", "bits"])

    return mark


def _count_exactly(bits: int, size: int, bitmap):
    """Second pass, by runs: the occurrences of n-grams that pass the filter,
    counted by their words."""
    def passes(code: np.ndarray, there: np.ndarray) -> np.ndarray:
        hp = code >> np.uint64(64 - bits)
        cut = (code >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)
        ok = np.ones(len(code), bool)
        for place in _places(hp, cut, bits, size):
            ok &= (there[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1) > 0
        return ok

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, there, held = _Words(), np.frombuffer(bitmap.value, np.uint8), {}
        for batch in _runs(slices(batches, "text")):
            for lang, numbers in _walk(batch, words):
                # an n-gram is known by the number of its first words, given
                # here, and its last word: no hash decides what is equal
                known, before = np.full(len(numbers) + 1, -1, np.int64), None
                for k, (at, code) in enumerate(_codes(lang, numbers, words), 1):
                    ok = passes(code, there)
                    if k > 1:  # a frequent n-gram's first and last words are frequent too
                        ok &= (known[at] >= 0) & (before[at + 1] >= 0)
                    at = at[ok]
                    pair = numbers[at] if k == 1 else known[at] << 32 | numbers[at + k - 1]
                    _, first, number, f = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
                    known = np.full(len(numbers) + 1, -1, np.int64)
                    known[at] = number
                    before = known
                    own = held.setdefault((lang, k), {})
                    for a, n in zip(at[first].tolist(), f.tolist()):
                        phrase = b" ".join(map(words.words.__getitem__, numbers[a:a + k].tolist()))
                        own[phrase] = own.get(phrase, 0) + n
            if sum(map(len, held.values())) > HELD_PHRASES:
                yield from out(held)
        yield from out(held)

    def out(held: dict[tuple[str, int], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        """What a task has counted over its runs so far, a row for each
        bucket of phrases."""
        rows = [(zlib.crc32(phrase) >> (32 - bits), lang, phrase, k, n)
                for (lang, k), own in held.items() for phrase, n in own.items()]
        held.clear()
        if rows:
            rows.sort(key=itemgetter(0))
            at, langs, phrases, ks, fs = zip(*rows)
            buckets, first = np.unique(np.array(at), return_index=True)
            ends = pa.array([*first.tolist(), len(rows)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), *(pa.ListArray.from_arrays(ends, x) for x in (
                    pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                    pa.array(ks, pa.int32()), pa.array(fs, pa.int64())))], ["bucket", "langs", "phrases", "ks", "fs"])

    return count


def _add_up(threshold: int):
    """A bucket's phrases with their counts over all tasks, the frequent ones."""
    def merge(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, int] = {}
        for batch in parts:
            langs, phrases, ks, fs = (batch.column(c).flatten().to_pylist() for c in ("langs", "phrases", "ks", "fs"))
            for *phrase, f in zip(langs, phrases, ks, fs, strict=True):
                phrase = tuple(phrase)
                total[phrase] = total.get(phrase, 0) + f
        kept = [(*phrase, f) for phrase, f in total.items() if f >= threshold]
        names = ("lang", "phrase", "k", "f")
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in kept], t) for i, t in enumerate(kinds)], names)

    return merge


def count_frequent(docs: DataFrame, threshold: int = 100, lang_col: str = "lang",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f): every phrase of 1 to 5 words with at least
    ``threshold`` contiguous occurrences in its language, with its exact
    count; and (lang, n): the words of each language."""
    if threshold < 1:
        raise ValueError("threshold must be positive")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
                        text_of(docs, text_col).alias("text"))
    bits = min(30, max(4, (partitions_for(docs, PARTITION_BYTES) - 1).bit_length()))
    with small_batches(spark):
        runs = stored(texts.mapInArrow(_summarise(bits), "lang string, hp int, n long, blob binary"), "phrase-runs")
    words = runs.where("hp is null").groupBy("lang").agg(F.sum("n").alias("n"))
    counted = runs.where("hp is not null")
    survivors = (counted.select("hp", "blob").join(counted.groupBy("hp").agg(F.sum("n").alias("mass")), "hp").groupBy("hp")
                 .applyInArrow(_survivors(threshold), "hp int, code long"))
    marked = (survivors.mapInArrow(_filter_words(bits, FILTER_BITS), "at long, bits long")
              .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())  # FILTER_BITS / 64 rows at most
    there = np.zeros(FILTER_BITS // 64, "<i8")
    there[marked.column("at").to_numpy()] = marked.column("bits").to_numpy()
    bitmap = spark.sparkContext.broadcast(there.tobytes())
    with small_batches(spark):
        counts = stored(texts.mapInArrow(_count_exactly(bits, FILTER_BITS, bitmap), "bucket int, langs array<string>, "
                                         "phrases array<string>, ks array<int>, fs array<long>").groupBy("bucket")
                        .applyInArrow(_add_up(threshold), "lang string, phrase string, k int, f long"), "phrase-counts")
    return counts, words


def collocations(docs: DataFrame, threshold: int = 100, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top``
    phrases of 2 to 5 words by score, count and phrase.

    A phrase's a occurrences are held against its parts': cut after its first
    words into parts with l and r occurrences it scores 1000 a n div (l r), n
    being the language's words; the lowest cut counts, of equal ones the
    first. A phrase inside a longer one that occurs as often is left out.

    A null language is ``und``; a null text is empty and counts nothing;
    repeated rows count each by itself; equal scores and counts are ordered by
    the phrase's bytes. An empty table gives no rows. Arithmetic is decimal
    with 38 digits, so that products are exact and too large ones raise.
    """
    counts, words = count_frequent(docs, threshold, lang_col, text_col)
    return score_phrases(counts, words, top)


def score_phrases(counts: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The collocations of phrases counted by ``count_frequent``, all parts
    of which are among them."""
    some = counts.where("k > 1").withColumn("w", F.split("phrase", " ", -1))
    cut = some.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr(
        "transform(sequence(1, k - 1), c -> struct(c, array_join(slice(w, 1, c), ' ') as x,"
        " array_join(slice(w, c + 1, k - c), ' ') as y))")).alias("cut")).select("lang", "phrase", "a", "cut.*")
    part = counts.select("lang", "phrase", "f")
    scored = (cut.join(part.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l")), ["lang", "x"])
              .join(part.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r")), ["lang", "y"])
              .join(words, "lang")
              .withColumn("score", F.expr("(cast(a as decimal(18)) * 1000 * cast(n as decimal(15))) div "
                                          "(cast(l as decimal(18)) * cast(r as decimal(18)))")))
    lowest = (scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "c", "l", "r", "a", "n")).alias("s"))
              .select("lang", "phrase", "s.*"))
    # every phrase inside a longer one, with the longer one's count
    inside = (some.where("k > 2").select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1),"
        " i -> array_join(slice(w, i, m), ' '))))")).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where("longer is null or longer < a")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
