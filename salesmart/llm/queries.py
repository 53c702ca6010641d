"""Registered queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (backoff_automaton, benchmark_containment, best_fit_packing, chat_snapshots, cnn_toxicity,
                           histogram_packing, markov_secrets, periodic_runs, quality_rules, shard_table,
                           simhash_vptree, subword_classifier, whitening)
from salesmart.llm.common import table

#: The vocabulary file of the packing queries.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.risk_controlled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                          alpha=0.05, delta=0.05)
    return found.drop("text_key").withColumnRenamed("stratum", "lang")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.packed_rows(table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048)


def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_snapshots.collapsed_chats(table(spark, sf_dir, "conversations"))


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = subword_classifier.fit(documents, table(spark, sf_dir, "labels"), "quality")
    return subword_classifier.scores(documents, model, threshold=0.3)


def op5_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnn_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op6_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = [f"shard-{k:03d}" for k in range(shard_table.SHARDS)]
    return shard_table.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", shards)


def op7_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_packing.packed_documents(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024,
                                              end_id=0, with_ids=False)


def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return markov_secrets.summary(markov_secrets.secret_spans(documents, markov_secrets.fit(documents)))


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_vptree.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_containment.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                                  shingle_words=5, share=0.8)
    return found.select("doc_id", "item_id", "shared", "n_shingles").distinct()


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"), components=16, scale=64, shift=1_000_000)


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """The run query's input, by its contract: every tenth text by crc32 repeats some of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w):
        n, g = F.size(w), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda own, i: F.when(i < a, own).otherwise(
            F.get(w, (a + (i - a) % p).cast("int")))), " ")

    planted = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), F.lit(0))
    return documents.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")), min_words=12)
    # the longest run, of equal ones the first by start and period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return backoff_automaton.document_scores(table(spark, sf_dir, "documents"), held_out, order=2)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_best_fit_packing, op3_chat_snapshots, op4_subword_quality, op5_cnn_toxicity,
        op6_shard_table, op7_histogram_packing, op8_markov_secrets, op9_simhash_near_duplicates,
        op10_benchmark_containment, op11_embedding_whitening, op12_periodic_runs,
        op13_backoff_scores)}
