"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common, decontamination, neardup, packing, quality, toxicity


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that score 0.7 or more. The classifier learns from the labelled rows of the documents table."""
    model = quality.fit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter(F.col("score") >= 0.7).select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that score under 0.3. The machine learns from the labelled rows of the documents table."""
    model = toxicity.fit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("score") < 0.3).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the least id of each class of near copies."""
    return neardup.keep_one(docs).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of the benchmark."""
    return decontamination.without_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The stages learn from and hash texts in ways that SQL cannot express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = common.settle(stage(spark, docs, sf_dir))
    return docs
