"""Quality rules by distribution divergence (operator 2).

The histogram of a document over character classes, and the one over the most common words of its
language, are compared with those of the language by the Jensen-Shannon distance (base 2, so 0 to 1).
Short documents are guarded: a histogram of a few characters or words is noise and isn't judged.

The references come from all documents: one pass counts characters and words by language. Every language has one,
whatever its share. Those of the BROADCAST largest languages go to the workers; the others meet their documents in a join.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import by_bytes, materialize, prepared, raw

SYMBOLS = b"#*$%&|<>"
# Character classes by first byte of the UTF-8 form; following bytes (0x80-0xBF) aren't counted.
CLASSES = ["lower", "upper", "digit", "space", "newline", "symbol", "punctuation", "other"]
_NONE = len(CLASSES)


def _class_table() -> np.ndarray:
    out = np.full(256, CLASSES.index("punctuation"), np.uint8)
    for name, members in (("lower", range(0x61, 0x7B)), ("upper", range(0x41, 0x5B)), ("digit", range(0x30, 0x3A)),
                          ("space", b" \t\x0b\x0c\r"), ("newline", b"\n"), ("symbol", SYMBOLS), ("other", range(0xC0, 256))):
        out[list(members)] = CLASSES.index(name)
    out[0x80:0xC0] = _NONE
    return out


_CLASS = _class_table()
#: Languages whose references are broadcast, 109 rows each.
BROADCAST = 1000


@dataclass(frozen=True)
class Rules:
    """min_words and max_repeat_percent make `base_failed`. The distances above which a document goes,
    and the characters and words below which they aren't looked at. A reference has
    `common_words` words; every language has one."""

    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 100
    min_chars: int = 200
    max_class_distance: float = 0.30
    max_word_distance: float = 0.55


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=_NONE + 1)[:_NONE]


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    whole = b"".join(words)
    word_chars = len(whole.translate(None, bytes(range(0x80, 0xC0))))
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    duplicates = 0
    for line in lines:
        if line in seen:
            duplicates += bool(line.split())
        else:
            seen.add(line)
    return word_chars, len(text) - len(text.translate(None, SYMBOLS)), duplicates, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    covered = np.zeros(len(words), bool)
    for place, window in enumerate(windows):
        if often[window] > 1:
            covered[place:place + 3] = True
    return int(covered.sum())


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms that have a count each."""
    p, q = counts / counts.sum(), reference / reference.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        divergence = np.where(p > 0, p * np.log2(p / m), 0).sum() / 2 + np.where(q > 0, q * np.log2(q / m), 0).sum() / 2
    return float(np.sqrt(max(divergence, 0.0)))


_COUNTS = "lang string, kind string, item string, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text"):
        words: dict[str, Counter] = defaultdict(Counter)
        classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(_NONE, np.int64))
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = raw(text)
            words[lang].update(data.lower().split())
            classes[lang] += class_counts(data)
        rows = [(lang, "word", w.decode("utf-8", "replace"), n) for lang, c in words.items() for w, n in c.items()]
        rows += [(lang, "class", name, int(n)) for lang, c in classes.items() for name, n in zip(CLASSES, c, strict=True) if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64()))],
            names=["lang", "kind", "item", "n"])


def references(docs: DataFrame, rules: Rules) -> DataFrame:
    """(lang, kind, item, n): the class counts of each language with words, its `common_words` most
    frequent words (the smaller word on a tie) and, as the item null, its count of all other words."""
    counts = (docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text").mapInArrow(_count, _COUNTS)
              .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    counts = materialize(counts, "op2-counts")
    totals = counts.where("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
    common = counts.where("kind = 'word'").withColumn("_p", place).where(F.col("_p") <= rules.common_words).drop("_p")
    rest = (common.groupBy("lang").agg(F.sum("n").alias("_n")).join(totals, "lang")
            .select("lang", F.lit("word").alias("kind"), F.lit(None).cast("string").alias("item"), (F.col("total") - F.col("_n")).alias("n")))
    return common.unionByName(counts.where("kind = 'class'")).unionByName(rest).join(totals.select("lang"), "lang", "left_semi")


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, class_distance double, word_distance double")


def judge(docs: DataFrame, rules: Rules = Rules(), keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every document (default doc_id), then those of RESULT, whatever else the table holds.

    Null texts have no words and fail by length. A null language is a language of its own. The distances are null
    where a guard holds. Repeated rows are judged alike. A column of `keep` named as in RESULT is replaced. `docs` needs doc_id, text and lang.
    """
    prepared(docs.sparkSession)
    taken = {x.split()[0] for x in RESULT.split(", ")}
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in taken]
    refs = materialize(references(docs, rules), "op2-references")
    sizes = refs.where("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang")
    large = [lang for lang, _ in sizes.limit(BROADCAST + 1).collect()]
    others, large = len(large) > BROADCAST, large[:BROADCAST]
    rows: dict[str, list] = defaultdict(list)
    # At most BROADCAST languages of common_words + 9 rows.
    names = docs.sparkSession.createDataFrame([(x,) for x in large], "lang string")
    for lang, *row in refs.join(F.broadcast(names), "lang", "left_semi").select("lang", "kind", "item", "n").collect():
        rows[lang].append(row)
    shared = docs.sparkSession.sparkContext.broadcast({lang: _reference(r, rules) for lang, r in rows.items()})
    fields = [docs.schema[c] for c in keep]
    given = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col("text").alias("_text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"))
    schema = ", ".join([f"_k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)] + [RESULT])
    number = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            langs, found = batch.column("_lang").to_pylist(), shared.value
            if "_ref" in batch.schema.names:
                found = {}
                for at, lang in enumerate(langs):
                    if lang not in found:
                        own = batch.column("_ref")[at].as_py()
                        found[lang] = _reference([(x["kind"], x["item"], x["n"]) for x in own], rules) if own else None
            rows = [_row(raw(t), *(found.get(lang) or ({}, None)), rules) for t, lang in zip(batch.column("_text").to_pylist(), langs, strict=True)]
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays(
                batch.columns[:number] + [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                names=[f"_k{i}" for i in range(number)] + [x.split()[0] for x in RESULT.split(", ")])

    if others:
        # Each of these languages has fewer words than BROADCAST others, so that none is a hot key.
        small = names.select(F.col("lang").alias("_lang"))
        packed = refs.join(F.broadcast(names), "lang", "left_anti").groupBy(F.col("lang").alias("_lang")).agg(F.collect_list(F.struct("kind", "item", "n")).alias("_ref"))
        rest = given.join(F.broadcast(small), "_lang", "left_anti").join(packed, "_lang", "left").select(*given.columns, "_ref")
        given = given.join(F.broadcast(small), "_lang", "left_semi").select(*given.columns)
        out = given.mapInArrow(run, schema).unionByName(rest.mapInArrow(run, schema))
    else:
        out = given.mapInArrow(run, schema)
    return out.withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)})


def _reference(rows: list, rules: Rules) -> tuple[dict[bytes, int], dict[str, np.ndarray]]:
    """The places of a language's common words, and its histograms, from its (kind, item, n)."""
    slots: dict[bytes, int] = {}
    hists = {"word": np.zeros(rules.common_words + 1), "class": np.zeros(_NONE)}
    for kind, item, n in sorted(rows, key=lambda r: (r[0], -r[2], r[1] or "")):
        if kind == "class":
            hists["class"][CLASSES.index(item)] = n
        elif item is None:
            hists["word"][rules.common_words] = n
        else:
            hists["word"][slots.setdefault(item.encode(), len(slots))] = n
    return slots, hists


def _row(text: bytes, slots: dict[bytes, int], ref: dict[str, np.ndarray] | None, rules: Rules) -> tuple:
    words = text.split()
    base = base_counts(text, words)
    failed = len(words) < rules.min_words or 100 * base[3] > rules.max_repeat_percent * len(words)
    by_class = by_word = None
    if ref is not None:
        classes = class_counts(text)
        if classes.sum() >= rules.min_chars:
            by_class = distance(classes, ref["class"])
        if len(words) >= rules.min_words:
            found = np.fromiter((slots.get(w, rules.common_words) for w in text.lower().split()), np.int64, len(words))
            by_word = distance(np.bincount(found, minlength=rules.common_words + 1), ref["word"])
    kept = not failed and not (by_class or 0) > rules.max_class_distance and not (by_word or 0) > rules.max_word_distance
    return (len(words), *base, failed, kept, by_class, by_word)
