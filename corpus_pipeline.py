"""Corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and
returns the documents it keeps, with the columns of documents (the last one
returns the packed pieces). ``run`` writes every stage's result as Parquet in
the session's shared folder and reads it back for the next stage. Once a stage's result
is written its predecessor's is removed, so at most two copies of the corpus stand there; the
last one stays and is the caller's.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.packing import packing
from tidemark.llm.quality_rules import keep_quality
from tidemark.llm.secrets import redact
from tidemark.llm.simhash import keep_one
from tidemark.session import checkpoint_dir
from tidemark.sources.publish import drop_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the likelihood ratio reject go."""
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: No stage's chain can be written in SQL (likelihood ratio, XXH64 links, forest, tokens); tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus_pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        here = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if before is not None:
            drop_folder(spark, before)
        before = here
    return docs
