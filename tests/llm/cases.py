"""Rows that every operator must take: nulls, empty and long texts, repeated
rows and ids, and columns named like those that operators make."""

from pyspark.sql import functions as F

LONG = "Word after word without end, it goes on and on. " * 4_000
CLASHING = ("row", "sha", "norm", "part", "run", "seg", "bucket", "start", "length", "score", "keep_id", "kept", "fp",
            "root", "hs", "w", "b", "key", "component_id", "order", "toxic", "toxic_", "host", "path", "rule", "lang",
            "__sha", "__key", "__row", "id", "whole", "stay_id", "out_key", "stay_key", "out_id", "stay_sha", "a.b")

ROWS = [(1, "one small text"), (1, "one small text"), (2, None), (3, ""), (4, LONG), (5, LONG), (None, "no id at all"),
        (None, None), (6, "  \n\t "), (7, "ünï cödé 東京 wörds"), (7, "another text of the same id"), (8, "x")]


def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})


def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
