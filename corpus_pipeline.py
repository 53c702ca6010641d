"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import (benchmark_containment, histogram_packing, markov_secrets, simhash_vptree,
                           subword_classifier)
from salesmart.llm.common import table
from salesmart.llm.queries import TOKENIZER
from salesmart.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores under 0.3 go; null and blank texts score as the labels' odds do."""
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"), "quality")
    return subword_classifier.keep_good(docs, model, threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (see simhash_vptree.keep_one for nulls and ties)."""
    return simhash_vptree.keep_one(docs, shingle_words=4, max_distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return benchmark_containment.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; all documents stay, n_chars follows the text."""
    return markov_secrets.mask_secrets(docs, markov_secrets.fit(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 ids."""
    return histogram_packing.packed_documents(docs, TOKENIZER, capacity=1024, end_id=0, with_ids=False)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("secrets", secrets), ("packing", packing)]

#: SQL has no XXH64, so it cannot express the pipeline; the tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{scratch_path(spark, 'pipeline')}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
