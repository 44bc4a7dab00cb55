"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import (
    bloom_lm,
    cgk_decontamination,
    classifier_chain,
    importance,
    license_join,
    line_chunks,
    quality_rules,
    sentencepiece_backend,
    simhash_pigeonring,
    source_audit,
    splitter_shards,
    suffix_dedup,
    token_counts,
)
from siltstone.llm.common import table
from siltstone.llm.oracles import ORACLES


def op1_classifier_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    texts = docs.join(labels.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic"), "doc_id")
    return classifier_chain.score(docs, classifier_chain.fit(texts, ["junk", "toxic"]))


def op2_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    out = quality_rules.judge(table(spark, folder, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op3_splitter_shards(spark: SparkSession, folder: str) -> DataFrame:
    return splitter_shards.shard(table(spark, folder, "documents"))


def op4_simhash_pigeonring(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_pigeonring.near_duplicates(table(spark, folder, "documents")).drop("_root")


def op5_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    out = line_chunks.deduplicate(table(spark, folder, "documents"))
    return out.select("doc_id", *line_chunks.COUNTS, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("kept_md5"))


def op6_license_join(spark: SparkSession, folder: str) -> DataFrame:
    return license_join.scan(table(spark, folder, "documents"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, folder, "documents")).drop("kept")


def op8_bloom_lm(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_lm.score(table(spark, folder, "documents"))


def op9_cgk_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return cgk_decontamination.contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_sentencepiece_backend(spark: SparkSession, folder: str) -> DataFrame:
    out = sentencepiece_backend.tokenize(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", "round_trip", "parity", F.md5(F.array_join("ids", ",").cast("binary")).alias("ids_md5"))


def op11_token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(table(spark, folder, "documents"))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_classifier_chain, op2_divergence_rules, op3_splitter_shards, op4_simhash_pigeonring, op5_line_chunks, op6_license_join,
        op7_suffix_dedup, op8_bloom_lm, op9_cgk_decontamination, op10_sentencepiece_backend,
        op11_token_lengths, op12_source_divergence, op13_importance_resampling, pipeline)}


def statements() -> dict[str, str]:
    return dict(ORACLES)
