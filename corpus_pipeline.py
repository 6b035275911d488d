"""Corpus cleaning pipeline: quality rules, toxicity, near-dedup, secret scan, best-fit packing.

Each stage takes all rows that its predecessor kept. The first four return the
columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawlake.llm import minhash, packing, quality, secrets, toxicity
from drawlake.llm.common import table, write_and_reread


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram ratio."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).where("quality_rules.kept").drop("quality_rules")


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at five-word shingles and a similarity of 0.8."""
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with likely secrets replaced by ``[SECRET]``."""
    found = secrets.scan(docs, secrets.fit(docs))
    clean = found.withColumn("text", secrets.redact(F.col("text"), F.col("secrets")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset."""
    import public_tokenizers
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 4096)
    return packing.pack_best_fit(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), 4096)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: The n-gram, kernel and forest models have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_and_reread(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
