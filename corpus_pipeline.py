"""A corpus pipeline of the text operators: each stage works on what its predecessor kept."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import cgk_decontamination, line_chunks, quality_rules, sentencepiece_backend, simhash_pigeonring
from siltstone.llm.common import materialize, prepared, table


def _beside(docs: DataFrame, taken: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with other names for the columns that an operator's results would replace, and the way back."""
    aside = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c in set(taken)}
    return docs.withColumnsRenamed(aside), {new: old for old, new in aside.items()}


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the base rules or the divergence from their language reject go; all others stay as they are.

    A null or empty text has no words and goes. A null language is one of its own. Texts are judged whole. Repeated rows are
    judged alike. Columns of any name are kept. An empty table stays empty.
    """
    given, back = _beside(docs, [x.split()[0] for x in quality_rules.RESULT.split(", ")])
    judged = quality_rules.judge(given, keep=given.columns).where("kept").select(*given.columns)
    return judged.withColumnsRenamed(back).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated chunks of lines go from the texts; n_chars follows. Every document stays.

    A null text stays null, and so does its n_chars; a text whose lines all go is empty. Of equal places the smallest id keeps
    its lines, a null one before all numbers. Rows that agree in id and text get the same text. Texts of any length are cut
    whole. Columns of any name are kept. An empty table stays empty.
    """
    given, back = _beside(docs, line_chunks.COUNTS)
    cut = line_chunks.deduplicate(given).select(*given.columns).withColumnsRenamed(back)
    return cut.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates stays, as it is: that with the smallest id.

    Fingerprints of 3-word shingles that differ in up to 2 bits link documents. Null and empty texts have one fingerprint and
    are one group. A null id counts as smaller than any number; of repeated rows one stays. Columns of any name
    are kept. An empty table stays empty.
    """
    return simhash_pigeonring.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold an item of the benchmark go; all others stay as they are.

    Null and empty texts hold none and stay, as do documents if the benchmark is empty. Texts are searched whole. Repeated rows go
    or stay together. Columns of any name are kept. An empty table stays empty.
    """
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    found = cgk_decontamination.contaminations(docs.select("doc_id", "text", th.alias("_th")), table(spark, folder, "benchmark"), keep=["doc_id", "_th"])
    found = materialize(found.select(F.col("doc_id").alias("id_"), F.col("_th").alias("th_")).distinct(), "pipeline-leaks")
    rows = docs.select(F.struct("*").alias("d"), F.col("doc_id").alias("id"), th.alias("th"))
    return rows.join(found, F.col("id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_")), "left_anti").select("d.*")


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with their token ids, their number, and whether decoding and parity hold.

    A null text is read as empty and has no ids. Texts are encoded whole. Repeated rows stay, alike. Columns named as
    the results (ids, n_tokens, round_trip, parity) are replaced, all others kept. An empty table stays empty.
    """
    return sentencepiece_backend.tokenize(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("tokens", tokens)]

# SQL has no SimHash, CGK embedding or tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table documents; each is written to the shared folder and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
