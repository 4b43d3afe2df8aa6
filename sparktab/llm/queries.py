"""Registered queries of this package and their DuckDB SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, mixture, negatives, neighbours, passages, phrases, pieces, quality, rules, simhash, surrogates,
               tokenfile, toxicity)
from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "perplexity", "score", "threshold", (~F.col("rejected")).alias("kept"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfile.token_folder(spark)
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), folder)
    return tokenfile.digests(spark, folder).withColumnRenamed("id", "doc_id")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.decode(pieces.encode(table(spark, sf_dir, "documents")))
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless",
                      F.sha2("text", 256).alias("text_sha256"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = surrogates.pseudonymise(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "text", F.size("kinds").cast("long").alias("n_entities"), "kinds")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture.mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passages.passages(table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("id", "doc_id").withColumnRenamed("ref_id", "ref_doc_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_quality, op3_token_files, op4_pieces, op5_surrogates, op6_mix, op7_neighbours,
                                 op8_simhash, op9_passages, op10_toxicity, op11_phrases,
                                 op12_quality_rules, op13_hard_negatives)}

ORACLE_SQL = {
    "op1_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256 FROM d""",
    "op6_mix": mixture.mix_sql(),
    "op11_phrases": phrases.collocations_sql(),
    "op13_hard_negatives": negatives.mine_sql(),
}
