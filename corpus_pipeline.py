"""The corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm import decontaminate, packing, quality_classifier, simhash, suffix_dedup
from quillgraph.llm.common import materialize, table
from quillgraph.llm.registry import BYTE_BPE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier predicts to be good. It learns from the labels whose rows are not held out."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), ~quality_classifier.held_out())
    return quality_classifier.classify(docs, model).filter("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest doc_id of each group of copies and near copies."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 bytes and more that an earlier document has; documents stay, with n_chars counted anew."""
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in mixture-controlled sequences."""
    return packing.pack(docs, BYTE_BPE)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", pack),
]

#: No stage can be expressed in SQL; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
