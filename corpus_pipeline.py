"""Corpus pipeline over ``documents``: five stages, each an operator of ``textloom.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontamination, mixing, near_copies, pii, quality_classifier
from textloom.llm.common import read, stored


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after texts have changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of copies and near copies: SimHash candidates, five-word similarity 0.8 or more."""
    return near_copies.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of texts; drops documents that consist mostly of them."""
    return _recounted(decontamination.remove_overlaps(docs, read(spark, sf_dir, "benchmark")))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return _recounted(pii.sanitise(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, and repeats of them, to the sources' target weights."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("personal data", sanitise),
    ("mixing", mix),
]
#: Not expressible in SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs)
    return docs
