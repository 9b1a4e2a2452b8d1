"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteledger.llm.decontaminate import drop_contaminated
from siteledger.llm.exact_dedup import drop_exact
from siteledger.llm.langid import drop_unknown, learn
from siteledger.llm.minhash import drop_near
from siteledger.llm.packing import pack
from siteledger.operators import shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected; centroids are learnt from a bounded sample of the labelled ones."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return drop_unknown(docs, learn(docs, F.col("lang"), F.col("text"), order))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity 0.8 or more."""
    return drop_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return pack(docs, added=True)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents``."""
    docs, base = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
