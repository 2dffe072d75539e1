"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import packing, quality, simhash, spans
from chatloom.llm.tables import Scratch

TOKENIZER = "byte_bpe_50k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts."""
    return quality.without_rejects(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return simhash.without_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark passage."""
    return spans.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]

# Fingerprints, alignment and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last stage's rows."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        if place:
            scratch.drop(STAGES[place - 1][0])
    return docs
