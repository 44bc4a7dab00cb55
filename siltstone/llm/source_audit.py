"""Divergence of sources by the words they use (operator 12).

The counts of a language's terms by source are a sparse matrix: groups by terms. Spark deals it out as strips
of columns, and strips times pairs of row blocks where there are many groups. A task keeps its part as quadtrees
of K x K quadrants in each node and goes down the trees of two row blocks together: where both quadrants are empty,
all their cells have the probability of an unseen term, and their share of the sum is a product; below others
it comes to leaves of K x K cells where at least one of the two has a count, and compares these cell by cell.

All arithmetic is on integers. A probability is 1 + floor(SCALE * (count + 1) / (N + V)).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import materialize, prepared, raw

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
K, LEVELS = 4, 3
SIDE = K ** LEVELS  # rows and columns of a tree
CELLS = 100_000  # counts in a strip, at about
HELD = 400_000  # different words that a task counts before it hands them on

# Terms are runs of letters and of whatever isn't ASCII; A-Z in lower case, all else is a gap.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# ---------------------------------------------------------------- counting

def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences, and documents with the term, as far as one task has seen them.

    A term comes up to once from each task and flush, so a term of every document is no hot key in the shuffle that follows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[tuple[str, str], Counter] = defaultdict(Counter)
        texts: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in words.items():
                terms = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()),
                     pa.array(counts.values(), pa.int64()), pa.array([texts[lang, source][t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "d"])
            words.clear()
            texts.clear()

        for batch in batches:
            for text, *group in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source")), strict=True):
                found = Counter(raw(text).translate(_TERMS).split())
                words[*group].update(found)
                texts[*group].update(found.keys())
            if sum(map(len, words.values())) > HELD:
                yield from flush()
        yield from flush()

    given = docs.select(F.col("text").cast("binary").alias("text"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")])
    return given.mapInArrow(run, "lang string, source string, term string, n long, d long")


def kept_cells(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, total, leads): the counts of the terms in at least `min_docs` documents of a language; `leads` in
    one row of each term.

    One shuffle, by language and term: what the tasks have seen is summed by source, then each sum meets its term's totals.
    """
    partial = term_counts(docs).repartition("lang", "term")
    by_source = partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    found = by_source.withColumns({"total": F.sum("n").over(term), "docs": F.sum("d").over(term), "leads": F.min("source").over(term) == F.col("source")})
    return found.where(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "total", "leads")


# ---------------------------------------------------------------- arithmetic

def probability(counts: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (counts + 1) / size), exact for any counts below size; SCALE = 1000 ** 3 is multiplied in three steps."""
    rest, out = np.asarray(counts, np.int64) + 1, np.int64(0)
    size = np.asarray(size, np.int64)
    whole, rest = rest // size, rest % size
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // size
        rest = rest % size
    return 1 + whole * SCALE + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / q)"""
    return (p - q) ** 2 // q


# ---------------------------------------------------------------- trees

class Tree:
    """SIDE rows and SIDE columns of probabilities, most of them that of an empty cell (`zero`, by row).

    `bits[level]` says which of the K ** level x K ** level quadrants hold a nonzero cell; those of the last level, K x K cells
    each, are the leaves.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, zero: np.ndarray) -> None:
        self.zero = zero
        cells = np.repeat(zero[:, None], SIDE, 1)
        cells[rows, columns] = values
        self.leaves = cells.reshape(SIDE // K, K, SIDE // K, K).transpose(0, 2, 1, 3)  # leaf row, leaf column, row, column
        filled = np.zeros((SIDE // K, SIDE // K), bool)
        filled[rows // K, columns // K] = True
        self.bits = [filled]
        while len(self.bits[0]) > 1:
            n = len(self.bits[0]) // K
            self.bits.insert(0, self.bits[0].reshape(n, K, n, K).any((1, 3)))


def meet(a: Tree, b: Tree, width: int) -> np.ndarray:
    """For all rows g of `a` and h of `b` the sum over `width` columns of divergence(p_g, p_h).

    Both trees are gone down together. A quadrant of columns that is empty for the rows of both is priced at once.
    """
    unseen = np.zeros((SIDE, SIDE), np.int64)  # columns in empty quadrants of both, by row of a and of b
    row_a = row_b = column = np.zeros(1, np.int64)
    child = np.arange(K ** 3)
    i, j, c = child // (K * K), child // K % K, child % K
    for level, (bits_a, bits_b) in enumerate(zip(a.bits, b.bits, strict=True)):
        side = SIDE // K ** level
        wide = np.clip(width - column * side, 0, side)
        full = (bits_a[row_a, column] | bits_b[row_b, column]) & (wide > 0)
        empty = np.zeros((SIDE // side, SIDE // side), np.int64)
        np.add.at(empty, (row_a[~full], row_b[~full]), wide[~full])
        unseen += empty.repeat(side, 0).repeat(side, 1)
        row_a, row_b, column = row_a[full], row_b[full], column[full]
        if side > K:
            row_a, row_b, column = ((x[:, None] * K + y).ravel() for x, y in ((row_a, i), (row_b, j), (column, c)))
    out = unseen * divergence(a.zero[:, None], b.zero[None, :])
    by_leaf = out.reshape(SIDE // K, K, SIDE // K, K).transpose(0, 2, 1, 3).copy()
    inside = np.arange(K)[None, :] < (width - column * K)[:, None]  # the last leaf may hang over
    each = divergence(a.leaves[row_a, column][:, :, None, :], b.leaves[row_b, column][:, None, :, :])
    np.add.at(by_leaf, (row_a, row_b), (each * inside[:, None, None, :]).sum(3))
    return by_leaf.transpose(0, 2, 1, 3).reshape(SIDE, SIDE)


def strip_sums(rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, sizes: np.ndarray, left: int, right: int) -> Iterator[tuple[int, int, int, int]]:
    """(g, h, sum, width): the strip's share for the ordered pairs of a group of the row block `left` with one of `right`.

    `sizes` are N + V of all groups by number, `columns` numbers of terms from 0 without gaps: the `width` terms that either block has.
    """
    blocks = {left, right}
    known = {x: np.arange(x * SIDE, min((x + 1) * SIDE, len(sizes))) for x in blocks}
    zero = {x: np.ones(SIDE, np.int64) for x in blocks}
    for x in blocks:
        zero[x][:len(known[x])] = probability(np.zeros(len(known[x]), np.int64), sizes[known[x]])
    values = probability(counts, sizes[rows])
    there, back = np.zeros((SIDE, SIDE), np.int64), np.zeros((SIDE, SIDE), np.int64)
    order = np.argsort(columns, kind="stable")
    rows, columns, values = rows[order], columns[order], values[order]
    width = int(columns[-1]) + 1 if len(columns) else 0
    for first in range(0, width, SIDE):
        lo, hi = np.searchsorted(columns, [first, first + SIDE])
        trees = {}
        for x in blocks:
            own = rows[lo:hi] // SIDE == x
            trees[x] = Tree(rows[lo:hi][own] % SIDE, columns[lo:hi][own] - first, values[lo:hi][own], zero[x])
        there += meet(trees[left], trees[right], min(SIDE, width - first))
        if left != right:
            back += meet(trees[right], trees[left], min(SIDE, width - first))
    for x, g in enumerate(known[left]):
        for y, h in enumerate(known[right]):
            if g != h:
                yield int(g), int(h), int(there[x, y]), width
                if left != right:
                    yield int(h), int(g), int(back[y, x]), width


# ---------------------------------------------------------------- the operator

def group_sizes(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """A row for each (lang, source) that occurs: its number `g` within the language, the language's `terms` (V), `size` (N + V) of both,
    and into how many strips and row blocks the language's counts are dealt. The windows hold groups, not documents or terms."""
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("cells"), F.count_if("leads").alias("terms"))
    found = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    lang = Window.partitionBy("lang")
    terms = F.coalesce(F.sum("terms").over(lang), F.lit(0))
    return found.join(own, ["lang", "source"], "left").select(
        "lang", "source", (F.row_number().over(lang.orderBy("source")) - 1).alias("g"),
        terms.alias("terms"), F.greatest(F.coalesce("n", F.lit(0)) + terms, F.lit(1)).alias("size"),
        F.greatest(F.coalesce(F.sum("n").over(lang), F.lit(0)) + terms, F.lit(1)).alias("lang_size"),
        F.greatest(F.ceil(F.coalesce(F.sum("cells").over(lang), F.lit(0)) / CELLS), F.lit(1)).cast("int").alias("strips"),
        F.ceil(F.count("*").over(lang) / SIDE).cast("int").alias("blocks"))


def _block_pairs(block: Column | None = None) -> Column:
    """Pairs (left, right) of row blocks, left <= right: those with the given block, or all."""
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    if block is not None:
        return F.transform(every, lambda o: F.struct(F.least(o, block).alias("left"), F.greatest(o, block).alias("right")))
    return F.flatten(F.transform(every, lambda a: F.transform(F.sequence(a, F.col("blocks") - 1), lambda b: F.struct(a.alias("left"), b.alias("right")))))


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, g, h, value, width) for all ordered pairs of groups of a language: the sum over `width` of its terms. Neither group has
    any of the others.

    A strip's cells and the sizes of its groups come together by strip and pair of row blocks, so neither is broadcast and no
    task holds more than the cells of two blocks in a strip. It gives up to SIDE * SIDE sums each way.
    """
    where, block = ["lang", "strip", "left", "right"], F.shiftright("g", (SIDE - 1).bit_length())
    strip = F.pmod(F.xxhash64("term"), F.col("strips").cast("long")).cast("int").alias("strip")
    dealt = cells.select("lang", "g", "term", "n", strip, F.inline(_block_pairs(block)))
    sizes = groups.select("lang", "g", "size", "blocks", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("strip"))
    sizes = sizes.select("lang", "strip", "g", "size", F.inline(_block_pairs())).where((block == F.col("left")) | (block == F.col("right")))
    sizes = sizes.toDF(*sizes.columns)  # columns of its own: the cells met the same groups

    def run(key: tuple, found: pa.Table, own: pa.Table) -> pa.Table:
        lang, _, left, right = (k.as_py() for k in key)
        numbers = own.column("g").to_numpy()
        table = np.ones(int(numbers.max()) + 1, np.int64)
        table[numbers] = own.column("size").to_numpy()
        columns = found.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.array(list(strip_sums(found.column("g").to_numpy().astype(np.int64), columns, found.column("n").to_numpy(), table, left, right)), np.int64).reshape(-1, 4)
        return pa.table({"lang": pa.array([lang] * len(sums), pa.string()), "g": pa.array(sums[:, 0], pa.int32()), "h": pa.array(sums[:, 1], pa.int32()), "value": pa.array(sums[:, 2]), "width": pa.array(sums[:, 3])})

    parts = dealt.groupBy(*where).cogroup(sizes.groupBy(*where)).applyInArrow(run, "lang string, g int, h int, value long, width long")
    return parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"), F.sum("width").alias("width"))


def _exact(count: str, size: str) -> Column:
    """`probability` as an expression; exact up to 28 digits."""
    return F.lit(1) + F.expr(f"(CAST({count} AS DECIMAL(19,0)) + 1) * {SCALE} div CAST({size} AS DECIMAL(19,0))")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and by which terms.

    Part `pair`: an item is another source h of the language, its value the sum over all kept terms of floor((p_g - p_h)^2 / p_h).
    Part `term`: an item is a term that the source has and uses more than its language does (p > q), its value
    floor((p - q)^2 / q); the first `top` of them. Kept are terms in at least `min_docs` documents of the language. Ranks
    go down by value, ties up by item (UTF-8).

    Null text, lang and source count as ''. Empty texts, and sources without any kept term, still make their group: with probability
    1 + floor(SCALE / V) for each term, and without rows of part `term`. In a language without kept terms all pairs have
    value 0; one with a single source has no pairs. Texts of any length are split whole; bytes that aren't UTF-8 are read as U+FFFD.
    Repeated rows count each time. An empty table gives no rows. Other columns, whatever their names, aren't read.
    """
    prepared(docs.sparkSession)
    docs = docs.select("text", "lang", "source")
    cells = materialize(kept_cells(docs, min_docs), "audit-cells")
    groups = materialize(group_sizes(docs, cells), "audit-groups")
    cells = cells.join(groups, ["lang", "source"])
    p, q = F.col("p"), F.col("q")
    names = groups.select("lang", "g", "source", "terms", _exact("0", "size").alias("p"))
    pairs = pair_sums(cells, groups).join(names, ["lang", "g"]).join(
        names.select("lang", F.col("g").alias("h"), F.col("source").alias("item"), F.col("p").alias("q")), ["lang", "h"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.expr("value + (terms - width) * ((p - q) * (p - q) div q)").alias("value"))
    terms = cells.withColumns({"p": _exact("n", "size"), "q": _exact("total", "lang_size")}).where(p > q).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
