import random
import subprocess
import sys
import zlib

from pyspark.sql import functions as F

from tests.llm.cases import none, odd
from tidemark.llm.toxicity import FEATURES, drop_toxic, features, fit_toxicity, score_toxicity


def corpus(spark, n=600):
    r = random.Random(5)
    word = lambda: "".join(r.choice(["er", "on", "th", "ti", "ne"]) for _ in range(r.randrange(1, 4)))
    bad = ["vileword", "rottenish", "nastything"]
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(r.randrange(20, 120))]
        toxic = int(r.random() < 0.2)
        if toxic:
            for _ in range(r.randrange(2, 6)):
                words.insert(r.randrange(len(words)), r.choice(bad))
        docs.append((i, " ".join(words)))
        if r.random() < 0.8:
            labels.append((i, toxic))
        docs[-1] += (toxic,)
    return (spark.createDataFrame(docs, "doc_id long, text string, truth int"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    got = {r.doc_id: r for r in score_toxicity(docs.drop("truth"), labels).collect()}
    truth = {r.doc_id: r.truth for r in docs.collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) >= 0.95


def test_held_out_labels_are_not_learned(spark):
    """Labels of held-out ids, and anything but the text, change nothing."""
    docs, labels = corpus(spark, 300)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    named = docs.drop("truth").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "score": F.lit(1.0)})
    a, b = (sorted(map(tuple, score_toxicity(d, x).collect())) for d, x in ((docs, labels), (named, other)))
    assert a == b


def test_drop_keeps_clean_documents_and_columns(spark):
    docs, labels = corpus(spark)
    wide = docs.withColumns({"score": F.lit("s"), "words": F.lit(1), "a.b": F.lit(2)})
    left = drop_toxic(wide, labels)
    assert left.columns == wide.columns
    truth = [r.truth for r in left.collect()]
    clean = docs.where("truth = 0").count()
    assert truth.count(0) >= 0.98 * clean and truth.count(1) <= 0.05 * (docs.count() - clean)


def test_few_toxic_labels_reject(spark):
    docs, _ = corpus(spark)
    bad = [r.doc_id for r in docs.where("truth = 1").orderBy("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    labels = docs.where(F.col("doc_id").isin(bad[:10]) | (F.col("truth") == 0)).select("doc_id", F.col("truth").alias("toxic"))
    truth = [r.truth for r in drop_toxic(docs, labels).collect()]
    clean = docs.where("truth = 0").count()
    assert truth.count(0) >= 0.98 * clean and truth.count(1) <= 0.5 * (docs.count() - clean)


def test_odd_rows_and_one_class(spark):
    df = odd(spark)
    for labels in ([], [(1, 0), (3, 0)], [(1, 1), (1, 0), (3, None), (None, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("x"))
        got = score_toxicity(df, frame).collect()
        assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
        assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    docs, labels = corpus(spark, 300)
    assert len(score_toxicity(docs.select("doc_id", "text").unionByName(df.select("doc_id", "text")), labels)
               .collect()) == 300 + df.count()


def test_no_rows(spark):
    docs, labels = corpus(spark, 100)
    assert score_toxicity(none(spark), labels).count() == 0
    assert fit_toxicity(none(spark), labels).trees is None


def test_features():
    row = dict(zip(FEATURES, features("You are vileword! SO b*d", {"vileword": 2.0, "vile*": 1.0}, frozenset({"vile"})),
                   strict=True))
    assert row["lexicon_share"] > 0 and row["near_second_person"] == 1 and row["exclamations"] > 0
    assert row["obfuscated"] > 0 and row["capitals"] > 0
    assert features("", {}, frozenset()) == [0.0] * len(FEATURES)


def test_workers_load_no_spark_ml():
    """Python workers import the module for its features alone."""
    code = "import sys, tidemark.llm.toxicity; sys.exit(bool({'pyspark.ml', 'pandas'} & set(sys.modules)))"
    assert subprocess.run([sys.executable, "-c", code], check=False).returncode == 0


def test_columns_that_no_file_holds(spark):
    docs, labels = corpus(spark, 300)
    odd_types = docs.selectExpr("*", "null as nothing", "interval 1 day as span")
    left = drop_toxic(odd_types, labels)
    assert left.columns == odd_types.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in drop_toxic(docs, labels).collect())
