"""Language-model scores from a log-frequency Bloom filter (operator 8).

The counts of words and of pairs of neighbouring words are quantised to levels (level q for counts from 2**(q-1)
on), and each n-gram is put into a Bloom filter once for each level up to its own; a count comes back by
probing level after level until one is missing, as the mean of the level's counts. Errors are one-sided: a
count may be read too high, never missed.

The filter grows with the corpus, 10 GB of text would make one of over 1 GB, so it isn't broadcast as a whole. It is dealt in blocks: the
first bits of an n-gram's hash say its block, a block has BITS for each key in it, and there is a block for about each million
tokens. So false levels stay as rare, and a block as large, at any size. Each batch of texts sends its distinct n-grams of a block, with
their counts in what is learned from, to the worker that has the block; it sets them, probes them, and sends the levels back to the batch.

Texts are split once: a batch of them is kept as its vocabulary and the places of its tokens in that. Counts, n-grams and
scores come from these.

The probability of a word w after v is (c(v w) + m * p(w)) / (c(v) + m), p(w) the add-half estimate from the word's own
level. The score of a text is the sum of its log10, its end included.

Beside it stands the exact add-half unigram score. Words with the `frequent` highest counts are looked up in a
broadcast table; the others meet their counts in a join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.common import by_bytes, discard, materialize, prepared, raw, release

END, START = b"\n", b"\t"  # can't be words
BITS, PROBES = 14, 5  # bits of a block for each key, and places of a key
KEPT = 40  # bits of an n-gram's hash behind those of its block
BATCH = 8 << 20  # bytes of text in a batch, at about
LONGEST = 64  # bytes of a word in the broadcast table
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_BEGIN = np.uint64(xxhash.xxh64_intdigest(START, 8))


@dataclass(frozen=True)
class Model:
    """frequent: words in the broadcast table of exact counts. weight: m above. Documents with crc32(doc_id) mod folds = held_out
    aren't learned from."""

    frequent: int = 200_000
    weight: float = 2.0
    folds: int = 5
    held_out: int = 1


def is_held_out(doc_id: object, model: Model) -> bool:
    """A null id isn't held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % model.folds == model.held_out


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, then its end."""
    return [*raw(text).lower().split(), END]


def levels(counts: np.ndarray) -> np.ndarray:
    """1 for 1, 2 for 2 and 3, 3 for 4 to 7 and so on."""
    return np.frexp(counts.astype(np.float64))[1]


#: The mean of the counts of each level; 0 where no level is found.
MEANS = np.concatenate([[0.0], (2.0 ** np.arange(0, 64) + 2.0 ** np.arange(1, 65) - 1) / 2])


# ---------------------------------------------------------------- blocks

class Block:
    """The part of the filter that n-grams with the same first bits share: `size` bits, 8 in a byte."""

    def __init__(self, data: np.ndarray) -> None:
        self.data, self.size = data, np.uint64(8 * len(data))

    @classmethod
    def of(cls, keys: np.ndarray, most: np.ndarray) -> Block:
        """The block of the n-grams `keys` with the levels `most`."""
        leveled = [_leveled(keys[most >= level], level) for level in range(1, int(most.max(initial=0)) + 1)]
        out = cls(np.zeros(max(8, BITS * sum(map(len, leveled)) // 8), np.uint8))
        bits = np.zeros(int(out.size), bool)
        for found in leveled:
            for spot in out._spots(found):
                bits[spot] = True
        return cls(np.packbits(bits, bitorder="little"))

    def _spots(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        x, y = bloom.mix(keys, 1), bloom.mix(keys, 2) | np.uint64(1)
        for probe in range(PROBES):
            yield ((x + np.uint64(probe) * y) % self.size).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for spot in self._spots(keys):
            out &= (self.data[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)
        return out

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """The levels of n-grams: level after level until one is missing."""
        found, alive, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 1
        while len(alive) and level < 64:
            alive = alive[self.has(_leveled(keys[alive], level))]
            found[alive] = level
            level += 1
        return found


def _leveled(keys: np.ndarray, level: int) -> np.ndarray:
    return bloom.mix(keys, 100 + level)


def _cuts(keys: np.ndarray, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of sorted keys, and where each one's keys begin and the last one's end."""
    block = (keys >> np.uint64(64 - block_bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.nonzero(np.diff(block))[0] + 1, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)
    return block[cuts[:-1]], cuts


def _planes(values: np.ndarray) -> bytes:
    """The numbers byte by byte, all first bytes in front: sorted keys and small counts are then mostly runs, which shuffles compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


# ---------------------------------------------------------------- batches

_TOKENS = "sizes binary, places binary, words array<binary>, held binary"


class Tokens:
    """The tokens of a batch of texts: how many each has, their places in the vocabulary, and which texts are held out."""

    def __init__(self, row: dict[str, Any]) -> None:
        self.sizes, self.places = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["places"], np.uint32)
        self.words, self.held = row["words"], np.frombuffer(row["held"], bool)
        self.first = np.cumsum([0, *self.sizes], dtype=np.int64)[:-1]

    @property
    def learned(self) -> np.ndarray:
        """Which tokens are learned from."""
        return np.repeat(~self.held, self.sizes)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.places[self.learned], minlength=len(self.words))

    def ngrams(self, block_bits: int) -> np.ndarray:
        """The words of the vocabulary alone, the start of a text, and each token with the one before it, by their hashes' first bits: those
        of the block and KEPT more, by which a block's million n-grams hardly ever fall together."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        here = hashes[self.places]
        before = np.roll(here, 1)
        before[self.first] = _BEGIN
        keys = np.concatenate([bloom.mix(hashes, 3), bloom.mix(np.full(1, _BEGIN, np.uint64), 3), bloom.mix(here ^ before * _PAIR, 7)])
        return keys & ~np.uint64((1 << max(0, 64 - block_bits - KEPT)) - 1)

    def counts(self) -> np.ndarray:
        """How often each of `ngrams` is learned, with those of several places counted at each."""
        return np.concatenate([self.word_counts(), [np.count_nonzero(~self.held)], self.learned])


def _pack(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for number, batch in enumerate(_gathered(by_bytes(batches, "_text", BATCH)), number):
            texts = [tokens(t) for t in batch.column("_text").to_pylist()]
            flat = [w for own in texts for w in own]
            index = {w: i for i, w in enumerate(dict.fromkeys(flat))}
            places = np.fromiter(map(index.__getitem__, flat), np.uint32, len(flat))
            held = np.array([is_held_out(i, model) for i in batch.column("_id").to_pylist()], bool)
            ids = batch.column("_id")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()), pa.array([places.tobytes()], pa.binary()),
                 pa.array([list(index)], pa.list_(pa.binary())), pa.array([held.tobytes()], pa.binary())],
                names=["batch", "ids", "sizes", "places", "words", "held"])
    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches put together up to about BATCH bytes of text."""
    held, size = [], 0
    for batch in batches:
        more = batch.column("_text").nbytes
        if held and size + more > BATCH:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held, size = [*held, batch], size + more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    """The rows of packed batches, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        batch = Tokens(row)
        counts = batch.word_counts()
        yield pa.RecordBatch.from_arrays([pa.array(batch.words, pa.binary()), pa.array(counts)], names=["token", "n"]).filter(pa.array(counts > 0))


def _by_block(block_bits: int):
    """For each batch and block its n-grams, each once and in order, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            batch = Tokens(row)
            keys, each = batch.ngrams(block_bits), batch.counts()
            order = np.argsort(keys)
            keys, first = _distinct(keys[order])
            counts = np.add.reduceat(each[order], first).astype(np.uint32)
            block, cuts = _cuts(keys, block_bits)
            parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["batch"]] * len(block), pa.int64()), pa.array(block, pa.int32()), pa.array([_planes(keys[a:b]) for a, b in parts], pa.binary()),
                 pa.array([_planes(counts[a:b]) for a, b in parts], pa.binary())], names=["batch", "block", "keys", "counts"])
    return run


def _distinct(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of sorted keys, and where each begins."""
    first = np.nonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))[0]
    return ordered[first], first


def _fill_and_probe(found: pa.Table) -> pa.Table:
    """The levels of the n-grams that each batch has of a block, by the block that all their counts make."""
    parts = [_numbers(k, np.uint64) for k in found.column("keys").to_pylist()]
    counts = np.concatenate([_numbers(c, np.uint32) for c in found.column("counts").to_pylist()])
    every = np.concatenate(parts)
    order = np.argsort(every, kind="stable")
    keys, first = _distinct(every[order])
    sums = np.add.reduceat(counts[order].astype(np.int64), first)
    block = Block.of(keys[sums > 0], levels(sums[sums > 0]))
    answers = np.zeros(len(every), np.uint8)
    answers[order] = np.repeat(block.probe(keys), np.diff([*first, len(every)]))
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return pa.table({"batch": found.column("batch"), "block": found.column("block"), "levels": pa.array([a.tobytes() for a in np.split(answers, cuts)], pa.binary())})


_SCORED = ["doc_id", "held_out", "n_tokens", "found", "part", "rest", "score"]


def _scored(ids: pa.Array, batch: Tokens, keys: np.ndarray, levels_: np.ndarray, logs: dict[bytes, float], below: float, model: Model) -> list[pa.Array]:
    """The columns of _SCORED for the texts of a batch; `keys` are its n-grams, `levels_` those of the different ones, in order."""
    order = np.argsort(keys)
    first = _distinct(keys[order])[1]
    counts = np.empty(len(keys))
    counts[order] = np.repeat(MEANS[levels_], np.diff([*first, len(keys)]))
    single, start, both = counts[:len(batch.words)], counts[len(batch.words)], counts[len(batch.words) + 1:]
    alone, before = ((single + 0.5) / below)[batch.places], np.roll(single[batch.places], 1)
    before[batch.first] = start
    both = np.minimum(both, before)
    scores = np.add.reduceat(np.log10((both + model.weight * alone) / (before + model.weight)), batch.first)

    exact = np.fromiter((logs.get(w, np.nan) for w in batch.words), np.float64, len(batch.words))[batch.places]
    is_known = ~np.isnan(exact)
    found = np.add.reduceat(is_known.astype(np.int64), batch.first)
    part = np.add.reduceat(np.where(is_known, exact, 0.0), batch.first)
    rest: list[list[dict]] = [[] for _ in batch.sizes]
    for at in np.nonzero(found < batch.sizes)[0]:
        lo, hi = batch.first[at], batch.first[at] + batch.sizes[at]
        unknown = Counter(batch.places[lo:hi][~is_known[lo:hi]].tolist())
        rest[at] = [{"token": batch.words[w], "n": n} for w, n in unknown.items()]
    return [ids, pa.array(batch.held), pa.array(batch.sizes), pa.array(found), pa.array(part),
            pa.array(rest, pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))), pa.array(scores)]


def score(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of `docs`.

    Null and empty texts are their end alone. A text of any length is split whole, and lies in one batch. Repeated rows count and are scored
    like any other. Where no document is learned from, N and V are 0, no token is known, and words share the probability 1 of
    half a count. An empty table gives no rows. `docs` needs doc_id and text; other columns, whatever their names, aren't read.
    """
    spark = prepared(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    packed = materialize(given.mapInArrow(_pack(model), f"batch long, ids array<{id_type}>, {_TOKENS}"), "op8-batches")
    tokens_ = packed.drop("ids")

    counts = materialize(tokens_.mapInArrow(_count_words, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")), "op8-counts")
    kinds, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    below = total + 0.5 * (kinds + 1)
    common = counts.where(F.octet_length("token") <= LONGEST).orderBy(F.desc("n"), "token").limit(model.frequent)  # so many rows of so many bytes
    frequent = spark.sparkContext.broadcast({bytes(token): math.log10((n + 0.5) / below) for token, n in common.toLocalIterator()})

    block_bits = max(6, (total >> 20).bit_length())  # a block for about each million tokens
    spread = tokens_.mapInArrow(_by_block(block_bits), "batch long, block int, keys binary, counts binary")
    answers = materialize(spread.groupBy("block").applyInArrow(_fill_and_probe, "batch long, block int, levels binary"), "op8-levels")
    del spread
    release(spark)

    def finish(one: pa.Table, found: pa.Table) -> pa.Table:
        levels_ = np.frombuffer(b"".join(found.sort_by("block").column("levels").to_pylist()), np.uint8)
        ids = one.column("ids").combine_chunks().flatten()
        batch = Tokens(one.drop_columns(["ids"]).to_pylist()[0])
        return pa.Table.from_arrays(_scored(ids, batch, batch.ngrams(block_bits), levels_, frequent.value, below, model), names=_SCORED)

    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, found long, part double, rest array<struct<token:binary,n:bigint>>, score double"
    out = packed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, schema)
    scored = materialize(out.withColumn("row", F.monotonically_increasing_id()), "op8-scored")
    discard(packed, answers)
    rare = scored.select("row", F.explode("rest").alias("t")).select("row", "t.token", F.col("t.n").alias("times")).join(counts, "token", "left")
    rare = rare.groupBy("row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
                                   F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(below))).alias("also"))
    return scored.drop("rest").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("found") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("also", F.lit(0.0))).alias("base_score"), "score")
