"""The corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from priceflow.llm import decontam, line_dedup, near_dup, packing, quality_bayes
from priceflow.llm.queries import BYTES, table
from priceflow.session import hand_off, scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, fitted on ``labels``, rejects."""
    return quality_bayes.good_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that documents of smaller ids hold."""
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of ``benchmark``."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.op8_packing(docs, BYTES)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed),
]

#: Classifier, edit distances and tokenizer files are not SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next; what a stage writes on the way is deleted with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            docs = hand_off(stage(spark, docs, sf_dir), kept)
    return docs
