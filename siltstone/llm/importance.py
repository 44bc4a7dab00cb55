"""Importance resampling towards a target distribution by hashed n-grams (operator 13).

Texts stay bytes: a table of 256 entries puts A-Z in lower case and blanks what separates words, bytes.split gives the words.
The CRC-32 of an n-gram is that of its first words, continued over a space and the next word, so each step from
n-1 to n is one more pass over a list of hashes. Bucket counts of batches are Counters, summed by Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import by_bytes, prepared, raw
from siltstone.operators.keys import number_rows

# Words are runs of digits, letters and of whatever isn't ASCII; A-Z in lower case, all else is a gap.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
RESULTS = ("n_features", "weight", "score", "rank")


@dataclass(frozen=True)
class Settings:
    """Longest n-gram, number of buckets, the seed of the draw, the fewest words of a drawn document, and the share drawn."""

    longest: int = 1
    buckets: int = 10_000
    seed: str = "2024"
    min_words: int = 20
    percent: int = 10


def words(text: str | bytes | None) -> list[bytes]:
    return raw(text).translate(_WORDS).split()


def hashes(found: Sequence[bytes], longest: int) -> Iterator[int]:
    """CRC-32 of all runs of 1 to `longest` words."""
    known = list(map(crc32, found))
    yield from known
    spaced = [b" " + w for w in found] if longest > 1 else []
    for n in range(1, longest):
        known = list(map(crc32, spaced[n:], known))
        yield from known


def bucket_counts(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Features of all rows of `text` by bucket. Each task gives a row for each bucket; what comes to the driver is a sum for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.buckets, np.int64)
        for batch in by_bytes(batches, "text", 2 << 20):
            counts: Counter[int] = Counter()
            for text in batch.column("text").to_pylist():
                counts.update(hashes(words(text), settings.longest))
            np.add.at(total, np.fromiter(counts, np.int64, len(counts)) % settings.buckets, np.fromiter(counts.values(), np.int64, len(counts)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(settings.buckets, dtype=np.int32)), pa.array(total)], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(settings.buckets, np.int64)
    for bucket, n in rows.where("n > 0").groupBy("bucket").agg(F.sum("n")).collect():  # one row for each bucket at most
        out[bucket] = n
    return out


def gains(here: np.ndarray, there: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares), by bucket, in doubles."""
    s, t, m = here.astype(float), there.astype(float), len(here)
    ratio = (t + 1) * (s.sum() + m) / ((s + 1) * (t.sum() + m))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    """A draw from the Gumbel distribution in thousandths, fixed by seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, target: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, n_features, weight, score, _drawable) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(  # eight bytes for each bucket
        gains(bucket_counts(docs, settings), bucket_counts(target, settings)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = shared.value
        for batch in by_bytes(batches, "text", 2 << 20):
            sizes, weights, long_enough = [], [], []
            for text in batch.column("text").to_pylist():
                found = words(text)
                buckets = np.fromiter(hashes(found, settings.longest), np.int64) % settings.buckets
                sizes.append(len(buckets))
                weights.append(int(by_bucket[buckets].sum()) // len(buckets) if len(buckets) else 0)
                long_enough.append(len(found) >= settings.min_words)
            ids = batch.column("doc_id")
            scores = [w + noise(i, settings.seed) for w, i in zip(weights, ids.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(weights, pa.int64()), pa.array(scores, pa.int64()), pa.array(long_enough, pa.bool_())],
                                             names=["doc_id", "n_features", "weight", "score", "_drawable"])

    given = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, n_features long, weight long, score long, _drawable boolean")


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each document of `docs`.

    `weight` is the floored mean gain of its features: how much more frequent their buckets are in the texts of `target`. `score`
    adds Gumbel noise fixed by the id, so that the highest scores are a sample without replacement in proportion to exp(weight / 1000).
    Of the documents with at least `min_words` words the highest `percent` in a hundred (floored) are drawn, ties to the smaller
    id; `rank` numbers them from 1 and is null for all others.

    Null and empty texts have no features, weight 0 and are never drawn (min_words >= 1). Texts of any length count whole. A null id
    draws as '' and comes before all numbers; repeated rows count each time and each may be drawn, in any order among
    themselves. Without target texts all gains come from `docs` alone. An empty table gives no rows. Other columns
    of either table, whatever their names, aren't read.
    """
    prepared(docs.sparkSession)
    rows = weigh(docs.select("doc_id", "text"), target.select("text"), settings)
    placed = number_rows(rows, [F.desc("_drawable"), F.desc("score"), F.asc("doc_id")], "rank", F.lit(0))
    drawn = placed.agg(F.floor(F.count_if("_drawable") * settings.percent / 100)).scalar()
    return placed.select("doc_id", "n_features", "weight", "score",
                         F.when(F.col("_drawable") & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))
