"""A training corpus from ``documents``: quality filter, near-duplicate removal, decontamination, secret masking, BPE.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns the same columns;
the last returns token ids. Each calls one operator of ``chainmark.llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainmark.llm import bpe, decontaminate, minhash, quality, secrets
from chainmark.llm.joins import stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier rejects go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of near duplicates, the document with the smallest id stays."""
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that contain a benchmark item go."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets are replaced by a mark, and the number of characters follows."""
    out = secrets.masked(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token ids of each text, with a digest of the text they decode to."""
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_masking", secret_masking),
    ("encoding", encoding),
]

#: SQL has no learned scores, signatures or merge rounds; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
