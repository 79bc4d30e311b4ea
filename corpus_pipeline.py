"""The corpus pipeline: documents to token ids, one operator a stage.

Each stage's result is written as Parquet and read again as the next one's
documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import bpe, decontaminate, quality, secrets, simhash
from sparkmart.llm.queries import RANK_FILE
from sparkmart.session import ensure_checkpoint_dir, small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _in_small_batches(stage):
    """Every stage sends whole texts to Python, on executors that keep their workers between stages."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


@_in_small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, docs, _table(spark, sf_dir, "labels"))


@_in_small_batches
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs)


@_in_small_batches
def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of weight."""
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


@_in_small_batches
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark."""
    return (docs.withColumn("text", secrets.redact(F.col("text")))
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


@_in_small_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", uncontaminated),
    ("secret_scan", without_secrets),
    ("byte_bpe", token_ids),
]

# The stages learn a classifier and run BPE merges, which SQL cannot express;
# tests/llm compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
