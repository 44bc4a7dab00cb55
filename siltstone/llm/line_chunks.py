"""Line deduplication by content-defined chunks of lines (operator 5), in DataFrame operations only.

A rolling hash over the hashes of the last WINDOW lines decides whether a chunk ends behind a line. So a
boundary depends on the lines next to it alone: text that is inserted or taken out in front of a passage
shifts no boundary inside it. Chunks with two or more lines that hold a word, found at several places
of the corpus and equal byte by byte, stay at the first of these places and go at all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import materialize, prepared

WINDOW, FACTOR, DIVISOR = 2, 31, 3
COUNTS = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")


def _chunked(docs: DataFrame) -> DataFrame:
    """d (the whole row), id, th (hash of the text), lines, starts (first line of each chunk, from 0)."""
    text = F.coalesce(F.col("d.text"), F.lit(""))
    out = docs.select(F.struct("*").alias("d")).select(
        "d", F.col("d.doc_id").alias("id"), F.xxhash64(text).alias("th"), F.split(text, "\n", -1).alias("lines"))
    out = out.withColumn("hashes", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")))

    def ends_before(i: Column) -> Column:
        rolled = F.lit(0).cast("long")
        for back in range(WINDOW, 0, -1):
            rolled = rolled * FACTOR + F.coalesce(F.get("hashes", i - back), F.lit(0).cast("long"))
        return rolled % DIVISOR == 0

    inner = F.when(F.size("lines") > 1, F.filter(F.sequence(F.lit(1), F.size("lines") - 1), ends_before)).otherwise(F.array().cast("array<int>"))
    return out.withColumn("starts", F.concat(F.array(F.lit(0)), inner)).drop("hashes")


def _length(k: Column) -> Column:
    """Lines of the chunk in place k of `starts`."""
    return F.coalesce(F.get("starts", k + 1), F.size("lines")) - F.get("starts", k)


def _chunks() -> Column:
    """(start, lines of the chunk) for every chunk of `lines`."""
    return F.transform("starts", lambda s, k: F.struct(s.alias("start"), F.slice("lines", s + 1, _length(k)).alias("part")))


def _multi(part: Column) -> Column:
    return F.size(F.filter(part, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))) >= 2


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, `text` without repeated chunks of lines, and the columns COUNTS.

    The first place of a chunk is the one in the smallest doc_id (null is smaller than any), then the
    smallest line. Rows that agree in doc_id and text count as one and get the same result. A null
    text stays null (one empty line). If every line goes, the text is empty. Other columns, whatever
    their names, stay as they are, but those named as in COUNTS are replaced. An empty table stays empty.
    """
    prepared(docs.sparkSession)
    place = F.struct("id", "th", "start").alias("place")
    pieces = _chunked(docs).select("id", "th", F.explode(_chunks()).alias("c")).where(_multi(F.col("c.part")))
    found = materialize(pieces.select("id", "th", F.col("c.start").alias("start"), F.xxhash64(F.array_join("c.part", "\n")).alias("h")), "op5-chunks")
    # Aggregated before the shuffle: a chunk that very many documents share is one row per task.
    seen = found.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("h")
    again = found.join(materialize(seen, "op5-repeated"), "h", "left_semi").groupBy("id", "th").agg(F.collect_set("start").alias("which"))
    again = materialize(again.withColumnsRenamed({"id": "id_", "th": "th_"}), "op5-candidates")

    # The bytes of those chunks alone, for the comparison. The tables of chunks grow with the corpus, so both sides are
    # dealt by key at any size, and texts move twice.
    of_row = F.col("id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_"))
    texts = (docs.select("doc_id", "text").select(F.struct("*").alias("d"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
             .join(again.hint("merge"), of_row).select("d.*", "which").dropDuplicates(["doc_id", "text"]))
    texts = _chunked(texts).select("id", "th", F.explode(F.filter(_chunks(), lambda c: F.array_contains("d.which", c["start"]))).alias("c"))
    texts = materialize(texts.select("id", "th", F.col("c.start").alias("start"), F.array_join("c.part", "\n").alias("bytes"))
                        .withColumn("h", F.xxhash64("bytes")), "op5-bytes")
    classes = texts.groupBy("h", "bytes").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("h", "bytes", "first")
    gone = (texts.join(materialize(classes, "op5-classes"), ["h", "bytes"]).where(F.struct("id", "th", "start") > F.col("first"))
            .groupBy("id", "th").agg(F.collect_set("start").alias("gone")).withColumnsRenamed({"id": "id_", "th": "th_"}))
    gone = materialize(gone, "op5-gone")

    plain = docs.select(F.struct("*").alias("d")).select(
        "d", F.col("d.doc_id").alias("id"), F.xxhash64(F.coalesce("d.text", F.lit(""))).alias("th")).join(gone.hint("merge"), of_row, "left").select("d", "gone")
    cut = _chunked(plain.select(F.col("d").alias("row"), F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text"), "gone"))
    kept = F.filter(_chunks(), lambda c: ~F.array_contains("d.gone", c["start"]))
    cut = cut.withColumn("kept", F.when(F.col("d.gone").isNotNull(), F.flatten(F.transform(kept, lambda c: c["part"]))).otherwise(F.col("lines")))
    text = F.when(F.col("d.gone").isNull(), F.col("d.text")).otherwise(F.array_join("kept", "\n"))
    values = (F.size("lines"), F.size("starts"), F.coalesce(F.size("d.gone"), F.lit(0)), F.size("lines") - F.size("kept"))
    names = [c for c in docs.columns if c not in COUNTS]
    return cut.select(*[(text if c == "text" else F.col("d.row")[c]).alias(c) for c in names],
                      *[v.cast("long").alias(c) for v, c in zip(values, COUNTS, strict=True)])
