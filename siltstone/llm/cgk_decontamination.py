"""Benchmark decontamination by CGK embedding and bit sampling (operator 9).

A text is a sequence of words: A-Z in lower case, every other ASCII character but letters and digits a
gap. An item of n words is found in a document if some run of its words can be turned into the item by at
most floor((1 - similarity) * n) insertions, deletions and replacements of words.

The CGK embedding (Chakraborty, Goldenberg, Koucky) walks over a sequence; at each step it writes down the
word it stands on, and a random function of step and word says whether it moves on. Two sequences a few edits
apart then differ in few places of what is written down. Each of `walks` embeddings is sampled at `bits`
places, `tables` times; windows of the item's size that agree with it in one sample are candidates, and
these are checked by exact edit distance.

A window is embedded only if enough of its words and of its pairs of neighbouring words occur in the
benchmark at all: an edit spoils one word and two pairs at most, so one that is near enough to an item holds
all but `edits` of its words and all but 2 * `edits` of its pairs, and none is dropped. Every word of every text
starts a window.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import by_bytes, prepared, raw

_GAPS = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class Search:
    """similarity: 1 - edits / words of the item, at least. Items of fewer than `min_words` words have too few of them to sample;
    they are searched for word by word, without edits. block_items items, of block_bytes in all, are searched for in one pass over the
    documents and sent to the executors; more of them take more passes."""

    similarity: float = 0.8
    min_words: int = 8
    walks: int = 8
    tables: int = 4
    bits: int = 3
    block_items: int = 20000
    block_bytes: int = 8 << 20
    seed: int = 9

    def edits(self, n: int) -> int:
        return int((1 - self.similarity) * n + 1e-9)


def words_of(text: str | None) -> list[bytes]:
    return raw(text).lower().translate(_GAPS).split()


def edit_distance(item: list, run: list, most: int) -> tuple[int, int] | None:
    """(edits, words of `run`) for the start of `run` that is nearest to `item`; None if over `most` edits."""
    n, far = len(item), most + 1
    if n > 100:  # a row at once: what a step to the right costs is a running minimum
        wanted, given = np.array(item), np.array(run[:n + most])
        places = np.arange(len(given) + 1)
        row = places
        for i in range(n):
            best = np.concatenate([[i + 1], np.minimum(row[:-1] + (given != wanted[i]), row[1:] + 1)])
            row = np.minimum.accumulate(best - places) + places
            if row.min() > most:
                return None
        return int(row.min()), int(row.argmin())
    row = list(range(min(len(run), n + most) + 1))
    width = len(row)
    for i in range(1, n + 1):
        before, row = row, [i if i <= most else far] + [far] * (width - 1)
        for j in range(max(1, i - most), min(width, i + most + 1)):
            row[j] = min(before[j - 1] + (item[i - 1] != run[j - 1]), before[j] + 1, row[j - 1] + 1)
        if min(row) > most:
            return None
    best = min(row)
    return (best, row.index(best)) if best <= most else None


class Index:
    """The items of a block: vocabulary, and their sampled embeddings as sorted keys."""

    def __init__(self, items: list[tuple[object, list[bytes]]], search: Search) -> None:
        self.search, self.items = search, items
        self.vocabulary: dict[bytes, int] = {}
        for _, words in self.items:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.unknown, self.pad = len(self.vocabulary), len(self.vocabulary) + 1
        self.lengths = sorted({len(words) for _, words in self.items})
        self.codes = [[self.vocabulary[w] for w in words] for _, words in self.items]
        # Lengths that differ by a quarter at most are looked for together first.
        self.groups: list[list[int]] = []
        for n in self.lengths:
            if self.groups and n <= 1.25 * self.groups[-1][0]:
                self.groups[-1].append(n)
            else:
                self.groups.append([n])
        self.counts = [Counter(c) for c in self.codes]
        # Pairs of two of the benchmark's common words are everywhere and tell nothing.
        total = Counter(x for c in self.codes for x in c)
        self.common = np.array([total[x] > max(10, total.total() / 500) for x in range(self.pad + 1)], bool)
        told = [[a * self.pad + b for a, b in zip(c, c[1:], strict=False) if not (self.common[a] and self.common[b])] for c in self.codes]
        pairs = np.array([x for t in told for x in t], np.int64)
        self.need: dict[int, int] = {}
        for c, t in zip(self.codes, told, strict=True):
            self.need[len(c)] = min(self.need.get(len(c), len(c)), len(t) - 2 * search.edits(len(c)))
        # Marks of the hashes of all pairs. Where two pairs fall together a window may pass that needn't; none is lost.
        self.marks = np.zeros(1 << max(16, int(64 * len(pairs) + 1).bit_length()), bool)
        self.marks[self.mark(pairs)] = True
        rng = np.random.default_rng(search.seed)
        self.hash = rng.integers(0, 1 << 63, len(self.vocabulary) + 2, np.uint64) * np.uint64(2) + np.uint64(1)
        self.longest = max(self.lengths, default=0)
        self.steps = rng.integers(0, 1 << 63, (search.walks, 2 * self.longest), np.uint64) * np.uint64(2) + np.uint64(1)
        self.places = rng.random((search.walks, search.tables, search.bits))
        self.mix = rng.integers(0, 1 << 63, (search.walks, search.tables, search.bits), np.uint64) * np.uint64(2) + np.uint64(1)
        rows = np.full((len(self.codes), self.longest), self.pad, np.int64)
        for i, c in enumerate(self.codes):
            rows[i, :len(c)] = c
        keys = self.keys(rows, np.array([len(c) for c in self.codes], np.int64)) if self.codes else np.zeros((0, 1), np.uint64)
        order = np.argsort(keys.ravel(), kind="stable")
        self.sorted_keys, self.owner = keys.ravel()[order], order // max(keys.shape[1], 1)

    def mark(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs * 0x9E3779B1 >> 12) & (len(self.marks) - 1)

    def keys(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(row, walk and table) keys of the sampled embeddings of padded sequences."""
        s, count = self.search, len(rows)
        rows = np.concatenate([rows, np.full((count, 1), self.pad, np.int64)], axis=1)
        at = np.zeros((s.walks, count), np.int64)
        every = np.arange(count)
        trace = np.empty((2 * int(lengths.max(initial=0)), s.walks, count), np.int64)
        for j in range(len(trace)):
            trace[j] = symbols = rows[every, at]
            moves = (self.hash[symbols] * self.steps[:, j, None]) >> np.uint64(63)
            at = np.minimum(at + moves.astype(np.int64), rows.shape[1] - 1)
        out = np.zeros((count, s.walks, s.tables), np.uint64)
        for w in range(s.walks):
            for t in range(s.tables):
                key = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(w * s.tables + t)
                for b in range(s.bits):
                    place = (self.places[w, t, b] * 2 * lengths).astype(np.int64)
                    key = (key ^ self.hash[trace[place, w, every]]) * self.mix[w, t, b]
                    key ^= key >> np.uint64(29)
                out[:, w, t] = key
        return out.reshape(count, -1)

    def search_texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, edits): for each text and item found in it the nearest run, the first on a tie."""
        if not self.items:
            return
        get, unknown, gap = self.vocabulary.get, repeat(self.unknown), [self.pad] * self.longest
        codes: list[int] = []
        bounds, ends = [], []
        for text in texts:  # a gap of the longest item's size behind each text: no window holds words of two
            bounds.append(len(codes))
            codes += map(get, words_of(text), unknown)
            ends.append(len(codes))
            codes += gap
        code = np.array(codes, np.int64)
        known = np.concatenate([[0], np.cumsum(code < self.unknown, dtype=np.int32)])
        second = np.nonzero((code[:-1] < self.unknown) & (code[1:] < self.unknown) & ~(self.common[code[:-1]] & self.common[code[1:]]))[0]
        pair = np.zeros(len(code), bool)
        pair[second + 1] = self.marks[self.mark(code[second] * self.pad + code[second + 1])]
        paired = np.concatenate([[0], np.cumsum(pair, dtype=np.int32)])
        starts, sizes = [], []
        for group in self.groups:
            # The longest window of the group holds the pairs of all its windows, the shortest item needs the fewest.
            most = group[-1]
            need = min(self.need[n] for n in group)
            at = np.nonzero(paired[most:] - paired[:-most] >= need)[0] if len(code) >= most else np.zeros(0, np.int64)
            at = at[code[at] < self.pad]
            for n in group:
                edits = self.search.edits(n)
                found = at[paired[at + n] - paired[at] >= self.need[n]]
                found = found[known[found + n] - known[found] >= n - edits]
                starts.append(found)
                sizes.append(np.full(len(found), n, np.int64))
        starts, sizes = np.concatenate(starts), np.concatenate(sizes)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        text_of = np.searchsorted(np.array(bounds), starts, side="right") - 1
        step = max(1, min(2000, WIDE // self.longest))
        for lo in range(0, len(starts), step):
            first, size, owner = starts[lo:lo + step], sizes[lo:lo + step], text_of[lo:lo + step]
            place = np.arange(self.longest)
            rows = np.where(place < size[:, None], code[np.minimum(first[:, None] + place, len(code) - 1)], self.pad)
            keys = self.keys(rows, size)
            left, right = np.searchsorted(self.sorted_keys, keys, "left"), np.searchsorted(self.sorted_keys, keys, "right")
            pairs: dict[int, set[int]] = defaultdict(set)
            for row, col in zip(*np.nonzero(right > left), strict=True):
                pairs[int(row)].update(map(int, self.owner[left[row, col]:right[row, col]]))
            for row, candidates in pairs.items():
                n, start, where = int(size[row]), int(first[row]), int(owner[row])
                most, window = self.search.edits(n), Counter(rows[row].tolist())
                run = code[start:min(start + n + most, ends[where])].tolist()
                for item in candidates:
                    if len(self.codes[item]) != n or sum(min(c, window[w]) for w, c in self.counts[item].items()) < n - most:
                        continue
                    if hit := edit_distance(self.codes[item], run, most):
                        rank = (hit[0], start - bounds[where], hit[1])
                        if rank < best.get((where, item), (n, 0, 0)):
                            best[where, item] = rank
        for (where, item), (edits, start, length) in sorted(best.items()):
            yield where, item, start, length, edits


class Phrases:
    """Short items, found where their words stand consecutively."""

    def __init__(self, items: list[tuple[int, list[bytes]]]) -> None:
        self.items: dict[tuple[bytes, ...], list[int]] = defaultdict(list)
        self.lengths: dict[bytes, set[int]] = defaultdict(set)
        for key, words in items:
            self.items[tuple(words)].append(key)
            self.lengths[words[0]].add(len(words))

    def search_texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, 0) for the first place of each item in each text."""
        for where, text in enumerate(texts if self.items else ()):
            found: dict[int, tuple[int, int]] = {}
            words = words_of(text)
            for at, word in enumerate(words):
                for n in self.lengths.get(word, ()):
                    for item in self.items.get(tuple(words[at:at + n]), ()):
                        found.setdefault(item, (at, n))
            for item, (at, n) in sorted(found.items()):
                yield where, item, at, n, 0


WIDE = 1 << 19  # symbols of the windows that are embedded together
TOGETHER = 512  # items of up to so many words have one index; longer ones have one for lengths that differ by 4 at most


class Searcher:
    """All items of a block, by (item, words): short ones as phrases, the others by indexes for about their length."""

    def __init__(self, items: list[tuple[int, list[bytes]]], search: Search) -> None:
        classes: dict[int, list[tuple[int, list[bytes]]]] = defaultdict(list)
        for item in items:
            if len(item[1]) >= search.min_words:
                classes[0 if len(item[1]) <= TOGETHER else len(item[1]).bit_length() // 2].append(item)
        self.phrases = Phrases([item for item in items if 0 < len(item[1]) < search.min_words])
        self.indexes = [Index(own, search) for own in classes.values()]

    def search_texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        yield from self.phrases.search_texts(texts)
        for index in self.indexes:
            # A text that is too short for every item of an index is left out: it would be padded to the longest.
            least = min(index.lengths) - max(map(index.search.edits, index.lengths))
            chosen = [i for i, t in enumerate(texts) if t and 2 * least <= len(t.encode("utf-8", "surrogatepass")) + 1] if least > TOGETHER // 2 else range(len(texts))
            for where, item, *rest in () if not chosen else index.search_texts([texts[i] for i in chosen]):
                yield chosen[where], index.items[item][0], *rest


def contaminations(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default doc_id), item_id, first_word, n_run_words and n_edits: a row for each document row and item found in it.

    first_word counts words from 0. Where several runs are as near, the first is given. Null, empty and shorter
    texts hold no item; null items and items without words aren't searched for; short items only without edits. A repeated item is
    found under each of its ids, a repeated document once for each row. Texts and items of any length are searched whole. Empty tables
    give no rows. Other columns don't matter.
    """
    spark = prepared(docs.sparkSession)
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    texts = items.select(F.col("text").alias("_item")).distinct()  # equal items are searched for once
    count, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_item")), F.lit(0))).first()
    blocks = max(1, -(-count // search.block_items), -(-size // search.block_bytes))
    keep = ["doc_id"] if keep is None else keep
    given = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col("text").alias("_text"))
    schema = ", ".join([f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
                       + ["item int, first_word long, n_run_words long, n_edits long"])
    out = None
    for block in range(blocks):
        found_texts = [r[0] for r in texts.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block).collect()]
        shared = spark.sparkContext.broadcast([(i, words) for i, t in enumerate(found_texts) if (words := words_of(t))])  # about block_bytes
        found = given.mapInArrow(_searcher(shared, search, len(keep)), schema)
        ids = spark.createDataFrame(list(enumerate(found_texts)), "item int, _item string").join(
            items.select("item_id", F.col("text").alias("_item")), "_item").select("item", "item_id")
        part = found.join(ids, "item").select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "item_id", "first_word", "n_run_words", "n_edits")
        out = part if out is None else out.unionByName(part)
    return out


def _searcher(shared, search: Search, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Searcher(shared.value, search)
        for batch in by_bytes(batches, "_text", 2 << 20):
            found = list(index.search_texts(batch.column("_text").to_pylist()))
            rows = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [c.take(rows) for c in batch.columns[:number]] + [pa.array([f[1] for f in found], pa.int32())] + [pa.array([f[i] for f in found], pa.int64()) for i in (2, 3, 4)],
                names=[f"_k{i}" for i in range(number)] + ["item", "first_word", "n_run_words", "n_edits"])
    return run
