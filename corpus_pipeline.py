"""A corpus pipeline over ``documents``: toxicity filter, exact dedup, SimHash
near-dedup, benchmark decontamination, best-fit packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all
rows its predecessor kept. Stages but the last return the columns of
``documents``. ``run`` writes every stage's result as Parquet to the shared
folder and reads it again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import stored, table
from tidemark.llm.decontamination import drop_contaminated
from tidemark.llm.exact import drop_copies
from tidemark.llm.packing import pack
from tidemark.llm.queries import NEAR_BITS, NEAR_SHINGLE, PACK_CAPACITY, PACK_END_ID
from tidemark.llm.simhash import drop_near
from tidemark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the
    labels of the documents it is given."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts: the smallest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the smallest doc_id."""
    return drop_near(docs, NEAR_SHINGLE, NEAR_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that a benchmark item contaminates."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), kind="space_free", capacity=PACK_CAPACITY,
                end_id=PACK_END_ID)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: Trained trees, XXH64 fingerprints and byte-pair ids are beyond SQL; the
#: tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
