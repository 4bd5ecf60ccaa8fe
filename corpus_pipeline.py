"""Corpus pipeline: quality, exact copies, near copies, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a
DataFrame, which `run` writes as Parquet to the shared folder and reads again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from brookmart.llm import decontamination, exact_dedup, packing, quality, simhash
from brookmart.llm.common import prepare, read
from brookmart.session import shared_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are at least `good but toxic` with the probability that
    `quality.select_good` asks for by default.  Toxicity is no reason to go."""
    prepare(spark)
    labels = read(spark, sf_dir, "labels")
    model = quality.train(docs, labels.select("doc_id", quality.grade().alias("grade")))
    return quality.select_good(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    prepare(spark)
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by operator 1 and its contract."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("exact_dedup", without_copies),
          ("near_dedup", without_near_copies), ("decontamination", without_benchmark),
          ("packing", packed)]

# The classifier and the fingerprints have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the rows of the last one."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
