"""Toxicity scores by gradient-boosted trees over dense features.

A lexicon is learned from labelled rows: words, and beginnings of words, that
documents labelled toxic have far more often than others. The features of a
text are its densities of lexicon words, how near they stand to the second
person, and its rates of capitals, punctuation and obfuscation. Trees are
boosted over them, and an isotonic regression on rows that the trees have not
seen turns their margin into a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, small_batches, storable, stored, text_of

# Spark ML is imported where it is used, on the driver: Python workers import
# this module for the features, and Spark ML would load pandas in each of them.
if TYPE_CHECKING:
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import IsotonicRegressionModel

#: Labelled ids that the model is fitted on, half of them toxic at most and half
#: clean, chosen by a hash of their id and weighted back to the classes' shares.
LABELLED_ROWS = 20_000
#: A lexicon entry stands in so many toxic documents at least, and is so many
#: times likelier in them; the strongest ones are kept.
LEAST_TOXIC_DOCUMENTS = 5
LEAST_RATIO = 8.0
LEXICON_ENTRIES = 5_000
#: Lengths of word beginnings that may be lexicon entries.
STEMS = (4, 5, 6)
#: Words on either side of a lexicon word within which the second person counts.
NEAR = 5
#: Rows of one in so many are kept from the trees for the calibration.
CALIBRATION_SHARE = 4
#: Share of the margin's own order that separates scores the isotonic steps tie.
TIE_SHARE = 1e-3

# Forms of the second person in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "tú ti usted ustedes vos vosotros tus su sus".split())

WORD = re.compile(r"[^\W_]+")
#: A word broken up or spelled with signs: b.a.d, b*d, b4d, $ad.
OBFUSCATED = re.compile(r"(?<!\S)[^\W\d_]+[*@$#0134!.-]+[^\W\d_]+(?![^\s,;:!?)])")
FEATURES = ("words", "lexicon_share", "lexicon_weight", "stem_share", "stem_weight", "lexicon_any", "second_person",
            "near_second_person", "capitals", "shouted", "exclamations", "questions", "punctuation", "obfuscated",
            "digits", "word_length")


def text_words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(text: str, lexicon: dict[str, float], heads: frozenset[str]) -> list[float]:
    """Dense features of a whole text (``FEATURES``); all zero without words
    but for rates of signs. ``heads`` are the first letters of all entries."""
    words = text_words(text)
    n, size = max(len(words), 1), max(len(text), 1)
    least = min(STEMS)
    hits, stems, weight, stem_weight = [], [], 0.0, 0.0
    for i, w in enumerate(words):
        if w[:least] not in heads:
            continue
        if (found := lexicon.get(w)) is not None:
            hits.append(i)
            weight += found
        elif best := max((lexicon.get(f"{w[:k]}*", 0.0) for k in STEMS if len(w) >= k), default=0.0):
            stems.append(i)
            stem_weight += best
    person = [i for i, w in enumerate(words) if w in SECOND_PERSON] if hits or stems else []
    seconds = len(person) if hits or stems else sum(map(SECOND_PERSON.__contains__, words))
    near, k = 0, 0
    for i in sorted(hits + stems):
        while k < len(person) and person[k] < i - NEAR:
            k += 1
        near += k < len(person) and person[k] <= i + NEAR
    raw = text.encode()
    letters = len(raw.translate(None, _NOT_UPPER))
    shouts = sum(map(str.isupper, text.split())) if letters * 20 > len(raw) else 0
    signs = len(raw.translate(None, _NOT_SIGN))
    return [math.log1p(len(words)), len(hits) / n, weight / n, len(stems) / n, stem_weight / n,
            float(min(len(hits) + len(stems), 3)), seconds / n, float(min(near, 3)), letters / size, shouts / n,
            text.count("!") / n, text.count("?") / n, signs / size, len(OBFUSCATED.findall(text)) / n if signs else 0.0,
            len(raw.translate(None, _NOT_DIGIT)) / size, sum(map(len, words)) / n]


_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_DIGIT = bytes(c for c in range(256) if not 48 <= c <= 57)
_SIGNS = b"!?.,;:*@$#%&-_'\"()[]{}<>/\\|+=~^`"
_NOT_SIGN = bytes(c for c in range(256) if c not in _SIGNS)


def with_features(texts: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``texts`` (its column ``text`` replaced by the feature columns)."""
    heads = frozenset(e.rstrip("*")[:min(STEMS)] for e in lexicon)
    kept = [f for f in texts.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, *(T.StructField(n, T.DoubleType()) for n in FEATURES)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [features(t, lexicon, heads) for t in batch.column("text").to_pylist()]
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array([r[k] for r in rows], pa.float64()) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(f.name for f in kept), *FEATURES])

    return texts.select(*(f.name for f in kept), "text").mapInArrow(run, schema)


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Entry -> log ratio from (text, toxic); ``abc*`` stands for a beginning.
    At most ``LEXICON_ENTRIES`` rows reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            entries, toxic = [], []
            rows = zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True)
            for text, label in rows:
                words = set(text_words(text))
                own = {w for w in words if len(w) >= 3} | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}
                entries += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(toxic, pa.int32())],
                                             names=["entry", "toxic"])

    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    ratio = ((F.col("n1") + 0.5) / (bad + 1)) / ((F.col("n0") + 0.5) / (good + 1))
    found = (labelled.select("text", "toxic").mapInArrow(run, "entry string, toxic int")
             .groupBy("entry").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
             .where(F.col("n1") >= LEAST_TOXIC_DOCUMENTS).withColumn("ratio", ratio)
             .where(F.col("ratio") >= LEAST_RATIO)
             .orderBy(F.desc("ratio"), F.desc("n1"), "entry").limit(LEXICON_ENTRIES))
    with small_batches(labelled.sparkSession):
        return {r["entry"]: math.log(r["ratio"]) for r in found.collect()}


@dataclass
class ToxicityModel:
    """``trees`` is None where the labelled rows had one class or none: then
    every score is ``base``."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    base: float

    def score(self, texts: DataFrame) -> DataFrame:
        """``texts`` with its column text replaced by score."""
        if self.trees is None:
            return texts.drop("text").withColumn("score", F.lit(self.base))
        kept = [c for c in texts.columns if c != "text"]
        margin = _margin(self.trees, with_features(texts, self.lexicon), kept)
        own = 1 / (1 + F.exp(-2 * F.col("margin")))
        return (self.steps.transform(margin)
                .select(*kept, ((1 - TIE_SHARE) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
                                + TIE_SHARE * own).alias("score")))


def _margin(trees: GBTClassificationModel, rows: DataFrame, kept: list[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    joined = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return trees.transform(joined).select(*kept, vector_to_array("rawPrediction")[1].alias("margin"))


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str,
                  held_out_share: int, most: int) -> DataFrame:
    """(text, toxic, rank in its class, weight) of labelled ids that are not held
    out, at most half of ``most`` of each class: rare toxic labels are all
    used. An id labelled twice takes its larger label."""
    known = (labels.select(F.col(label_id).alias("__id"), F.col(label_col).cast("int").alias("toxic"))
             .where("__id is not null and toxic is not null")
             .where(F.crc32(F.col("__id").cast("string")) % held_out_share != 0)
             .groupBy("__id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
             .withColumn("order", F.xxhash64("__id", F.lit(7))))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    clean, toxic = (known.where(F.col("toxic") == t).orderBy("order", "__id").limit(most // 2)
                    .withColumn("weight", F.lit(max(1.0, sizes.get(t, 0) / (most // 2)))) for t in (0, 1))
    ranked = clean.unionByName(toxic).withColumn(
        "rank", F.row_number().over(Window.partitionBy("toxic").orderBy("order", "__id")))
    return (docs.select(F.col(id_col).alias("__id"), text_of(docs, text_col).alias("text"))
            .join(F.broadcast(ranked), "__id").select("text", "toxic", "rank", "weight"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_id: str = "doc_id", label_col: str = "toxic", held_out_share: int = 5,
                 most: int = LABELLED_ROWS) -> ToxicityModel:
    """Fit on labelled ids whose crc32 (of the id as text) is not divisible by
    ``held_out_share``, ``most`` of them at most. One quarter of each class is
    kept from the trees and calibrates them."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import IsotonicRegression

    rows = stored(labelled_rows(docs, labels, id_col, text_col, label_id, label_col, held_out_share, most),
                  "toxic-labelled")
    calibrates = F.col("rank") % CALIBRATION_SHARE == 0
    sizes = {(r["c"], r["toxic"]): r["n"] for r in rows.groupBy(calibrates.alias("c"), "toxic")
             .agg(F.sum("weight").alias("n")).collect()}
    bad = sizes.get((False, 1), 0) + sizes.get((True, 1), 0)
    if min(sizes.get((c, t), 0) for c in (False, True) for t in (0, 1)) == 0:
        return ToxicityModel({}, None, None, bad / max(1, sum(sizes.values())))
    lexicon = learn_lexicon(rows.where(~calibrates))
    with small_batches(docs.sparkSession):
        known = stored(with_features(rows, lexicon), "toxic-features")
    train = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        known.where(~calibrates)).select("features", F.col("toxic").cast("double").alias("label"), "weight")
    trees = GBTClassifier(weightCol="weight", maxIter=20, maxDepth=3, stepSize=0.3, minInstancesPerNode=5, seed=7).fit(train)
    held = _margin(trees, known.where(calibrates), ["toxic", "weight"])
    # Most clean rows share a margin: one row per margin, weighted, instead of ties in one task.
    weighed = held.groupBy("margin").agg((F.sum(F.col("toxic") * F.col("weight")) / F.sum("weight")).alias("label"),
                                         F.sum("weight").alias("weight"))
    steps = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight").fit(weighed)
    return ToxicityModel(lexicon, trees, steps, bad / sum(sizes.values()))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   held_out_share: int = 5, most: int = LABELLED_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1) and
    predicted (1 from 0.5 on).

    A null text counts as empty and is scored. A null id is never held out and
    never labelled. Repeated rows are scored each by itself. Without labelled
    rows of both classes every score is the share of toxic ones (0 without
    any). Only the id and text columns of ``docs`` are read; an empty frame
    gives no rows.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, held_out_share=held_out_share, most=most)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out_share == 0, F.lit(False))
    scores = (model.score(docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text")))
              .select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
    return _scored(scores)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns. Null
    and empty texts are scored as empty ones, null ids like others; rows with
    equal texts go or stay together. Without labels of both classes all rows
    score the share of toxic labels. An empty frame stays empty."""
    model = fit_toxicity(docs, labels, id_col, text_col)
    packed = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("__row"), text_of(docs, text_col).alias("text"))
    return _scored(model.score(packed).where("score < 0.5").select("__row.*"))


def _scored(rows: DataFrame) -> DataFrame:
    """The rows written in small batches; whoever reads them later would run the
    features in batches of the session's size. Types that no file holds stay a plan."""
    if not storable(rows):
        return rows
    with small_batches(rows.sparkSession):
        return stored(rows, "toxic-scored")
