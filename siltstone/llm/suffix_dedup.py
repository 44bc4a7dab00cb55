"""Removal of repeated 50-byte strings by two-stage suffix sorting (operator 7).

A byte goes if a 50-byte string over it also starts in a document with a smaller doc_id. Such strings
are found by sorting suffixes, but no task could sort those of a whole corpus. So the texts are first
cut to what can repeat, and dealt so that equal strings meet:

1. The anchor of a 50-byte window is the smallest hash of its 24-byte strings, in 48 bits. Equal windows have equal
   anchors. For each anchor Spark aggregates the smallest and the largest doc_id that has it; where these are the
   same, none of its windows repeats. The others are marked in a Bloom filter of bounded size.
2. A second pass keeps the runs of windows with a marked anchor. A join gives each run the smallest doc_id with its
   anchor, its leader. Neighbouring runs with one leader are one piece, since a copied passage follows its leader.
3. Equal pieces of a leader collapse to one row with their smallest doc_id: every other document with the piece
   loses all of it. The different pieces of a leader are sorted together, and adjacent suffixes that share 50
   bytes tell from which doc_id on a piece's windows go.
4. Leaders with more than `crowd` bytes of different pieces aren't sorted in one task: their windows are aggregated one by one, by
   Spark, which spreads them over all tasks.

Two-stage sorting (Itoh and Tanaka): a suffix smaller than its successor is sorted directly, by its first 50
bytes. All others follow from a scan of the buckets of first bytes in ascending order: the predecessors of
sorted suffixes, taken in their order, are sorted, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.common import by_bytes, discard, materialize, prepared, raw, release

SIZE, ANCHOR = 50, 24
_SPAN = SIZE - ANCHOR + 1  # anchor-sized strings of a window
FILTER_BYTES = 32 << 20
CROWD = 2 << 20
_STOP = 0xFF  # no byte of UTF-8
_BITS = np.uint64(((1 << 48) - 1) << 16)
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- Sorting -------------------------------------------------------------------------------------

def suffix_order(text: np.ndarray, depth: int = SIZE) -> np.ndarray:
    """The suffixes of `text` (bytes) in an order that is right in their first `depth` bytes at least.

    The text counts as followed by a byte smaller than all others.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    values = np.concatenate([text.astype(np.int16) + 1, np.zeros(1, np.int16)])
    # Smaller than its successor or not: decided by the next byte that differs.
    change = np.nonzero(values[:-1] != values[1:])[0]
    nearest = change[np.searchsorted(change, np.arange(n))]
    smaller = values[nearest] < values[nearest + 1]

    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    direct = np.nonzero(smaller)[0]
    windows = np.ndarray((n,), f"S{depth}", padded.tobytes(), 0, (1,))
    # A shorter suffix is smaller than a longer one that begins with it and zeros.
    order = np.lexsort((-direct, windows[direct])) if (direct > n - depth).any() and (text[-depth:] == 0).any() else np.argsort(windows[direct], kind="stable")
    direct = direct[order]

    starts = np.searchsorted(text[direct], np.arange(257))
    out: list[np.ndarray] = []
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    last = n - 1  # the suffix before the end of the text
    induced[text[last]].append(np.array([last]))
    for c in range(256):
        own = []
        wave = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        while len(wave):  # runs of c: each wave is what stands before the last one
            own.append(wave)
            before = wave[wave > 0] - 1
            wave = before[text[before] == c]
        bucket = np.concatenate([*own, direct[starts[c]:starts[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~smaller[before]]
        heads = text[before]
        for d in np.unique(heads[heads > c]):
            induced[d].append(before[heads == d])
    return np.concatenate(out)


def repeated(pieces: list[bytes], owners: np.ndarray, size: int = SIZE) -> list[list[tuple[int, int]]]:
    """For each piece the runs (start, end) of bytes covered by a `size`-byte string that a piece with a smaller owner has."""
    text = np.frombuffer(b"".join(p + bytes([_STOP]) for p in pieces), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in pieces])
    order = suffix_order(text, size)
    piece = np.searchsorted(ends, np.arange(len(text)), side="right")
    order = order[ends[piece[order]] - 1 - order >= size]  # of suffixes long enough alone
    if not len(order):
        return [[] for _ in pieces]
    windows = np.ndarray((len(text) - size + 1,), f"V{size}", text.tobytes(), 0, (1,))[order]
    group = np.concatenate([[0], np.cumsum(windows[1:] != windows[:-1])])  # adjacent common prefixes of `size` bytes or more
    least = np.minimum.reduceat(owners[piece[order]], np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1]))
    gone = np.sort(order[least[group] < owners[piece[order]]])
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    if len(gone):
        cut = np.nonzero((np.diff(gone) > size) | (np.diff(piece[gone]) > 0))[0]
        for lo, hi in zip(gone[np.concatenate([[0], cut + 1])], gone[np.concatenate([cut, [len(gone) - 1]])], strict=True):
            base = int(ends[piece[lo]]) - 1 - len(pieces[piece[lo]])
            out[piece[lo]].append((int(lo) - base, int(hi) - base + size))
    return out


# --- Anchors -------------------------------------------------------------------------------------

def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbours."""
    count, out, done = len(values) - width + 1, values, 1
    while 2 * done <= width:
        out, done = np.minimum(out[:-done], out[done:]), 2 * done
    return np.minimum(out[:count], out[width - done:width - done + count]) if done < width else out


def anchor_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, last window, anchor): runs of neighbouring windows with one anchor, in order."""
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    count = len(data) - 8 - ANCHOR + 1
    empty = np.zeros(0, np.int64)
    if count < _SPAN:
        return empty, empty, empty, np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,))
    hashes = np.zeros(count, np.uint64)
    for at in range(0, ANCHOR, 8):
        hashes = (hashes ^ eight[at:at + count]) * _ODD
        hashes ^= hashes >> np.uint64(29)
    anchors = _least(hashes, _SPAN)
    # A window lies in one text: none of the 49 that reach over an end counts.
    inside = np.ones(len(anchors) + 1, np.int8)
    inside[-1] = 0
    for end in ends[:-1]:
        inside[max(0, end - SIZE + 1):end] = 0
    first = np.concatenate([[True], anchors[1:] != anchors[:-1]]) | np.concatenate([[True], inside[1:-1] != inside[:-2]])
    lo = np.nonzero(first)[0]
    hi = np.concatenate([lo[1:], [len(anchors)]]) - 1
    lo, hi = lo[inside[lo] == 1], hi[inside[lo] == 1]
    # Two texts of 50 bytes and more touch: windows of the second begin at its start.
    owner = np.searchsorted(ends, lo, side="right")
    keys = bloom.mix(anchors[lo], 5) & _BITS
    base = np.concatenate([[0], ends[:-1]])[owner]
    return owner, lo - base, hi - base, keys


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "_text", 1 << 20):
        ids = batch.column("_key").to_numpy()
        owner, _, _, keys = anchor_runs([raw(t) for t in batch.column("_text").to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[owner[order]]
        cut = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1]) if len(keys) else np.zeros(0, np.int64)
        lo, hi = (f.reduceat(ids, cut) if len(cut) else ids for f in (np.minimum, np.maximum))
        # Most anchors have one document here, and zeros take no room in a shuffle.
        yield pa.RecordBatch.from_arrays([pa.array(keys[cut].view(np.int64)), pa.array(lo), pa.array(lo != hi), pa.array(np.where(lo != hi, hi, 0))], names=["anchor", "lo", "two", "hi"])


_SECTIONS = "_key long, _th long, base long, bytes binary, lo array<int>, hi array<int>, anchor array<long>"


def _second_pass(shared, bits: int):
    """The stretches of a text whose windows have a marked anchor, with their runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bloom.Bloom(shared.value, bits)
        for batch in by_bytes(batches, "_text", 1 << 20):
            texts = [raw(t) for t in batch.column("_text").to_pylist()]
            owner, lo, hi, keys = anchor_runs(texts)
            marked = marks.has(keys)
            owner, lo, hi, keys = owner[marked], lo[marked], hi[marked], keys[marked]
            apart = np.nonzero((owner[1:] != owner[:-1]) | (lo[1:] != hi[:-1] + 1))[0] + 1
            rows: list[list] = [[] for _ in range(6)]
            for a, b in zip(np.concatenate([[0], apart]), np.concatenate([apart, [len(owner)]]), strict=True):
                if a < b:
                    start = int(lo[a])
                    for column, value in zip(rows, (int(owner[a]), start, texts[owner[a]][start:int(hi[b - 1]) + SIZE], lo[a:b] - start, hi[a:b] - start, keys[a:b].view(np.int64)), strict=True):
                        column.append(value)
            place = pa.array(rows[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(place), batch.column("_th").take(place), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())]
                + [pa.array(rows[i], pa.list_(t)) for i, t in ((3, pa.int32()), (4, pa.int32()), (5, pa.int64()))],
                names=[x.split()[0] for x in _SECTIONS.split(", ")])
    return run


# --- Pieces --------------------------------------------------------------------------------------

_PIECES = "_key long, _th long, base long, leader long, bytes binary"


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sections with the leaders of their runs (those whose anchor repeats) to pieces: neighbouring runs of one leader."""
    for batch in batches:
        data = {c: batch.column(c) for c in ("_key", "_th", "base", "bytes", "lo", "hi", "found")}
        begin = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(data["lo"]).to_numpy())])
        lo, hi = (data[c].flatten().to_numpy() for c in ("lo", "hi"))
        row = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(data["found"]).to_numpy())
        found = data["found"].flatten()
        place, leader = begin[row] + found.field("place").to_numpy(), found.field("leader").to_numpy()
        order = np.argsort(place)
        row, place, leader = row[order], place[order], leader[order]
        apart = np.nonzero((place[1:] != place[:-1] + 1) | (leader[1:] != leader[:-1]) | (row[1:] != row[:-1]))[0] + 1
        first, last = np.concatenate([[0], apart]), np.concatenate([apart, [len(place)]]) - 1
        if not len(place):
            continue
        row, leader, start, end = row[first], leader[first], lo[place[first]], hi[place[last]] + SIZE
        texts = data["bytes"].to_pylist()
        parts = [texts[r][a:b] for r, a, b in zip(row.tolist(), start.tolist(), end.tolist(), strict=True)]
        base = data["base"].to_numpy()[row] + start
        yield pa.RecordBatch.from_arrays([data["_key"].take(pa.array(row)), data["_th"].take(pa.array(row)), pa.array(base), pa.array(leader), pa.array(parts, pa.binary())],
                                         names=[x.split()[0] for x in _PIECES.split(", ")])


def _sort_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece the runs of it that go for its own first document; rows come in the order of their leaders."""
    held: list[tuple[int, bytes, bytes, int]] = []
    size = 0

    def emit(rows: list[tuple[int, bytes, bytes, int]]) -> pa.RecordBatch:
        # Owners of different leaders don't compare, but equal windows have one leader, so they may be sorted together.
        runs = repeated([r[2] for r in rows], np.array([r[3] for r in rows], np.int64))
        hit = [(row, [{"lo": lo, "hi": hi} for lo, hi in found]) for row, found in zip(rows, runs, strict=True) if found]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r, _ in hit], pa.int64()), pa.array([r[1] for r, _ in hit], pa.binary()), pa.array([x for _, x in hit], pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))],
            names=["leader", "piece", "runs"])

    for batch in batches:
        for leader, name, part, least in zip(*(batch.column(c).to_pylist() for c in ("leader", "piece", "bytes", "least")), strict=True):
            if size > CROWD // 2 and leader != held[-1][0]:
                yield emit(held)
                held, size = [], 0
            held.append((leader, name, part, least))
            size += len(part)
    if held:
        yield emit(held)


_RUNS = "runs array<struct<lo:long,hi:long>>"


def _merge_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of a piece, as sorted places, to the runs that they cover."""
    for batch in batches:
        runs = []
        for places in batch.column("at").to_pylist():
            at = np.array(places, np.int64)
            cut = np.nonzero(np.diff(at) > SIZE)[0]
            runs.append([{"lo": int(lo), "hi": int(hi) + SIZE} for lo, hi in zip(at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])], strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column("leader"), batch.column("piece"), pa.array(runs, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))],
                                         names=["leader", "piece", "runs"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "bytes", 1 << 18):
        rows = [(leader, name, least, at, part[at:at + SIZE]) for leader, name, part, least in zip(*(batch.column(c).to_pylist() for c in ("leader", "piece", "bytes", "least")), strict=True)
                for at in range(len(part) - SIZE + 1)]
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["leader", "piece", "least", "at", "window"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "_text"):
        rows = []
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            data, runs = raw(text), []
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or []):
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
            left, at = [], 0
            for lo, hi in runs:
                left.append(data[at:lo])
                at = hi
            kept = b"".join([*left, data[at:]])
            rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("_id")] + [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def deduplicate(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept of every row of `docs`.

    kept is what is left of the text; a character cut in two reads as U+FFFD there, while kept_sha256 is of the bytes. A
    null text is empty. A null doc_id is smaller than any number, and rows of one doc_id are no smaller than each other,
    so repeated rows are alike. An empty table gives no rows. `docs` needs doc_id (a whole number) and text.
    """
    spark = prepared(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce("text", F.lit(""))
    given = docs.select(key.alias("_key"), F.xxhash64(text).alias("_th"), text.alias("_text"))

    anchors = given.where(F.octet_length("_text") >= SIZE).select("_key", "_text").mapInArrow(_first_pass, "anchor long, lo long, two boolean, hi long")
    anchors = anchors.groupBy("anchor").agg(F.min("lo").alias("leader"), F.max(F.when(F.col("two"), F.col("hi")).otherwise(F.col("lo"))).alias("hi"))
    anchors = materialize(anchors.where("leader < hi").select("anchor", "leader"), "op7-anchors")
    release(spark)
    bits = bloom.size_for(anchors.count(), FILTER_BYTES)
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = anchors.select("anchor").repartition(dealt, F.shiftright("anchor", 64 - bloom.BLOCK_BITS))
    shared = spark.sparkContext.broadcast(bloom.collect(blocks, bits, lambda b: b.column(0).to_numpy().view(np.uint64)))  # FILTER_BYTES at most

    sections = materialize(given.where(F.octet_length("_text") >= SIZE).mapInArrow(_second_pass(shared, bits), _SECTIONS), "op7-sections")
    runs = sections.select("_key", "_th", "base", F.posexplode("anchor").alias("place", "anchor")).join(anchors, "anchor")
    found = runs.groupBy("_key", "_th", "base").agg(F.collect_set(F.struct("place", "leader")).alias("found"))
    found = materialize(found, "op7-leaders")
    del runs
    release(spark)
    pieces = materialize(sections.drop("anchor").join(found, ["_key", "_th", "base"]).mapInArrow(_cut_pieces, _PIECES), "op7-pieces")
    discard(sections, found, anchors)
    del sections, found, anchors, blocks

    # Copies of a piece are one row for each task before they are shuffled. From here on a piece has a name of 128 bits.
    named = F.unhex(F.md5("bytes")).alias("piece")
    content = materialize(pieces.groupBy("leader", "bytes").agg(F.min("_key").alias("least")).select("leader", named, "bytes", "least"), "op7-contents")
    members = materialize(pieces.select("_key", "_th", "base", "leader", named, F.octet_length("bytes").alias("size")), "op7-members")
    discard(pieces)
    del pieces
    crowded = materialize(content.groupBy("leader").agg(F.sum(F.octet_length("bytes")).alias("n")).where(F.col("n") > crowd).select("leader"), "op7-crowded")
    calm = content.join(crowded, "leader", "left_anti").repartition(dealt, "leader").sortWithinPartitions("leader")
    own = calm.mapInArrow(_sort_pieces, f"leader long, piece binary, {_RUNS}")

    windows = materialize(content.join(crowded, "leader", "left_semi").mapInArrow(_windows, "leader long, piece binary, least long, at long, window binary"), "op7-windows")
    first = materialize(windows.groupBy("window").agg(F.min("least").alias("first")), "op7-first")
    hit = windows.join(first, "window").where(F.col("first") < F.col("least")).groupBy("leader", "piece").agg(F.array_sort(F.collect_set("at")).alias("at"))
    own = materialize(own.unionByName(hit.mapInArrow(_merge_windows, f"leader long, piece binary, {_RUNS}")), "op7-own")
    least = materialize(content.select("leader", "piece", "least"), "op7-least")
    discard(content, windows, first)
    del content, windows, first, calm, hit

    known = members.join(least, ["leader", "piece"])
    # A piece has one row of runs, so every place of a piece makes one row.
    copies = known.where(F.col("_key") > F.col("least")).select("_key", "_th", F.array(F.struct(F.col("base").alias("lo"), (F.col("base") + F.col("size")).alias("hi"))).alias("runs"))
    firsts = known.where(F.col("_key") == F.col("least")).join(own, ["leader", "piece"]).select(
        "_key", "_th", F.transform("runs", lambda r: F.struct((F.col("base") + r["lo"]).alias("lo"), (F.col("base") + r["hi"]).alias("hi"))).alias("runs"))
    spans = copies.unionByName(firsts).groupBy("_key", "_th").agg(F.flatten(F.collect_set("runs")).alias("spans"))
    spans = materialize(spans, "op7-spans")
    discard(members, least, own)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("_id"), key.alias("_key"), F.xxhash64(text).alias("_th"), text.alias("_text")).join(spans, ["_key", "_th"], "left")
    return rows.select("_id", "_text", "spans").mapInArrow(_finish, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
