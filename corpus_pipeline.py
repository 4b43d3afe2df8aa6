"""A training-data pipeline of five stages, each calling one operator of ``sparktab.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; all but the last return the columns of ``documents``.  ``run``
writes each stage's result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm import exact_dedup, mixture, pieces, quality, simhash
from sparktab.llm.common import saved, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the smallest doc_id stays."""
    return exact_dedup.dedup_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the smallest doc_id stays."""
    return simhash.near_dedup_documents(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that the sources come near their target weights."""
    return mixture.mix_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every row, decoded again to prove that nothing is lost."""
    out = pieces.decode(pieces.encode(docs))
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("mixing sources", mix_stage),
    ("SentencePiece", encode_stage),
]

#: A language model, connected components and sampled segmentations are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
