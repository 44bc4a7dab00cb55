"""SimHash near-duplicates, candidates by the pigeonring principle (operator 4).

A 64-bit fingerprint is cut into `segments` pieces that stand in a ring. If two fingerprints differ
in at most `distance` bits, some start exists from which every chain of l consecutive segments
has at most l * distance / segments differences. With 16 segments and distance 2 the first 7 segments of
such a chain agree (28 bits), the first 15 have at most one difference, and all 16 have at most two.

Candidates meet on the 28 bits and on one half of the next 8 segments (of two halves with at most one
difference, one agrees): 44 bits, so that random meetings stay rare at any size. They are pruned by the
chain's budgets and then checked in full. Equal fingerprints are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import by_bytes, materialize, prepared, raw
from siltstone.llm.components import components

BITS, SEED = 64, 42
SEGMENTS, DISTANCE = 16, 2
WIDTH = BITS // SEGMENTS
EQUAL = -(-SEGMENTS // DISTANCE) - 1          # segments without a difference: 7
ONE = 2 * SEGMENTS // DISTANCE - 1            # segments with one at most: 15
HALF = (ONE - EQUAL) * WIDTH // 2             # bits of half of the segments in between: 16
#: From this many fingerprints with the same 44 bits on, they are linked through shared neighbours.
CROWD = 32


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of a text, lower-cased for A-Z, over its word shingles, repeats included; unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        pieces = [b" ".join(words)]
    else:
        pieces = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in pieces), np.uint64)
    bits = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65536):  # 8 bytes a hash become 64
        part = hashes[start:start + 65536]
        bits += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3) -> DataFrame:
    """The columns `keep` and `_fp`, the fingerprint as a signed 64-bit number."""
    prepared(docs.sparkSession)
    number = len(keep)
    given = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col("text").alias("_text"))
    schema = ", ".join([f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)] + ["_fp long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            values = np.array([fingerprint(raw(t), shingle) for t in batch.column("_text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(batch.columns[:number] + [pa.array(values)], names=[f"_k{i}" for i in range(number)] + ["_fp"])

    return given.mapInArrow(run, schema).withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)})


def _mask(bits: int, skip: int = 0) -> Column:
    """`bits` ones after `skip` zeros, from the top."""
    value = ((1 << bits) - 1) << (BITS - skip - bits)
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def _turned(fp: Column, by: int) -> Column:
    """The ring read from `by` bits on."""
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def links(fps: DataFrame) -> DataFrame:
    """(a, b): pairs of distinct fingerprints `_fp` at most DISTANCE bits apart, enough of them that each
    two within that distance are joined directly or over others that are, too.

    In a bucket of up to CROWD fingerprints all such pairs are given. In a fuller one each fingerprint is
    linked to the smallest that shares a neighbour (itself or one free bit flipped) with it: two that share
    one are at most two bits apart, and two that are at most two bits apart share one. No pair is lost to
    reachability, and the rows stay in proportion to the fingerprints.
    """
    base = EQUAL * WIDTH
    keys = [F.struct(F.lit(2 * i + h).alias("slot"), _turned(F.col("_fp"), i * WIDTH).alias("r"),
                     _turned(F.col("_fp"), i * WIDTH).bitwiseAND(_mask(base).bitwiseOR(_mask(HALF, base + h * HALF))).alias("key"))
            for i in range(SEGMENTS) for h in range(2)]
    # A bucket has 2**20 different fingerprints at most, as 44 bits are equal.
    keyed = fps.select(F.explode(F.array(*keys)).alias("x")).select("x.*")
    full = materialize(keyed.withColumn("n", F.count("*").over(Window.partitionBy("slot", "key"))).where("n > 1"), "op4-buckets")

    few = full.where(F.col("n") <= CROWD)
    left, right = few.select("slot", "key", F.col("r").alias("ra")), few.select("slot", "key", F.col("r").alias("rb"))
    apart = F.col("ra").bitwiseXOR(F.col("rb"))
    chain = (F.bit_count(apart.bitwiseAND(_mask(ONE * WIDTH))) <= 1)
    pairs = left.join(right, ["slot", "key"]).where(F.col("ra") < F.col("rb")).where(chain).where(F.bit_count(apart) <= DISTANCE)

    crowded = full.where(F.col("n") > CROWD)
    flips = [F.lit(0).cast("long")] + [_mask(1, b) for b in range(base, BITS)]
    near = crowded.select("slot", "key", "r", F.explode(F.array(*flips)).alias("_bit"))
    fixed = F.when(F.col("slot") % 2 == 0, _mask(HALF, base)).otherwise(_mask(HALF, base + HALF))
    near = near.where(F.col("_bit").bitwiseAND(fixed) == 0)
    near = near.select("slot", "key", "r", F.col("r").bitwiseXOR(F.col("_bit")).alias("z"))
    stars = near.withColumn("m", F.min("r").over(Window.partitionBy("slot", "key", "z"))).where(F.col("r") > F.col("m"))

    def back(name: str) -> Column:
        turned = F.lit(None).cast("long")
        for i in reversed(range(SEGMENTS)):
            turned = F.when(F.shiftright("slot", 1) == i, _turned(F.col(name), (BITS - i * WIDTH) % BITS)).otherwise(turned)
        return turned

    found = pairs.select(back("ra").alias("a"), back("rb").alias("b")).unionByName(stars.select(back("m").alias("a"), back("r").alias("b")))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, keep: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """The columns `keep` (default doc_id), `fingerprint` (16 hex digits), `component_id` of every document,
    and the component's own key, a fingerprint, as `_root`.

    component_id is the smallest doc_id that can be reached over fingerprints at most two bits
    apart, the document's own included; null if none there has one. Null, empty and blank texts have the fingerprint zero and are
    linked by it like any other. Texts of fewer words than `shingle` are one shingle. Repeated rows stay;
    an empty table gives no rows. `docs` needs doc_id and text; its other columns don't matter.
    """
    keep = ["doc_id"] if keep is None else keep
    names = [f"_k{i}" for i in range(len(keep))]
    marked = materialize(fingerprints(docs.withColumn("_id", F.col("doc_id")), [*keep, "_id"], shingle).toDF(*names, "_id", "_fp"), "op4-fingerprints")
    classes = materialize(marked.groupBy("_fp").agg(F.min("_id").alias("_least")), "op4-classes")
    roots = components(links(classes.select("_fp")), "a", "b")
    # Every class that isn't linked to another one is its own root.
    rooted = classes.join(roots, F.col("_fp") == F.col("node"), "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    rooted = materialize(rooted, "op4-roots")
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = materialize(rooted.join(least, "_root").select("_fp", "_root", "component_id"), "op4-named")
    out = marked.join(named, "_fp").select(*names, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id", "_root")
    return out.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def one_of_each(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The rows of `docs` that stay: of each component the one with the smallest doc_id (null is smaller
    than any), and with the smaller hash of the text if several have it; of rows that agree in both, one.

    Only ids and hashes take part in the search; texts move once, to meet the chosen ids.
    """
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = near_duplicates(docs.select("doc_id", "text", th.alias("_th")), ["doc_id", "_th"], shingle)
    chosen = marked.groupBy("_root").agg(F.min(F.struct("doc_id", "_th")).alias("c")).select(
        F.col("c.doc_id").alias("id_"), F.col("c._th").alias("th_")).distinct()
    chosen = materialize(chosen, "op4-chosen")
    rows = docs.select(F.struct("*").alias("d"), F.col("doc_id").alias("id"), th.alias("th"))
    rows = rows.join(chosen, F.col("id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_")), "left_semi")
    return rows.dropDuplicates(["id", "th"]).select("d.*")
