"""License scan by an exact set-similarity join (operator 6), in DataFrame operations only.

A text block is a run of consecutive words, SLACK times as many as a template has, wherever lines are broken; templates
are the notices below, as sets of words. A block meets a template if it holds at least `containment` of the template's words. Words are
ordered by the number of documents that hold them, rare ones first. With `need` words to share, a block that meets a template
holds one of the template's first |t| - need + 1 words (prefix filter). So the places of these words are joined with
the templates, each with the words around it; what has fewer than `need` of the template's words there is out
(length filter), as is what can't reach `need` with the words from this one on in that order (positional filter). In what
remains every block is counted exactly, so the join finds every text that meets a template and no other.

Words that stand in no template can't be shared, so that texts are cut down to the places of the templates' words first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import ascii_lower, materialize, prepared

# Base phrases with their labels, and notices of public licenses with theirs.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
CONTAINMENT = 0.85
SLACK = 1.25
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """All words of a text, A-Z in lower case; none of a null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _GAPS), "")


def marked(ws: Column, vocabulary: Sequence[str]) -> Column:
    """The places, from 0, at which words of the vocabulary stand, with the words."""
    places = F.array_compact(F.transform(ws, lambda w, i: F.when(w.isin(list(vocabulary)), i)))
    return F.transform(places, lambda p: F.struct(p.alias("place"), F.get(ws, p).alias("word")))


def _starts(marks: Column, phrase: str) -> Column:
    """Where the words of a phrase stand consecutively."""
    parts = phrase.split()

    def here(mark: Column, i: Column) -> Column:
        same = mark["word"] == parts[0]
        for k, part in enumerate(parts[1:], 1):
            next_ = F.get(marks, i + k)
            same = same & F.coalesce((next_["word"] == part) & (next_["place"] == mark["place"] + k), F.lit(False))
        return same

    return F.transform(F.filter(marks, here), lambda m: m["place"])


def width(template: str, slack: float = SLACK) -> int:
    """Words of a block for a template."""
    return math.ceil(slack * len(template.split()) - 1e-9)


def matches(texts: DataFrame, templates: dict[str, str], containment: float, slack: float = SLACK) -> DataFrame:
    """(row, label, score): every text and template that meet, with the largest share of the template in a block. `texts` has `row` and
    `marks`, the places of the templates' words in order; other words may be among them."""
    spark = texts.sparkSession
    sets = {label: set(text.split()) for label, text in templates.items()}
    need = {label: math.ceil(containment * len(s) - 1e-9) for label, s in sets.items()}
    every = sorted({w for s in sets.values() for w in s})
    # As many rows as the templates have words; the counts are of all texts.
    held = F.array_intersect(F.transform("marks", lambda m: m["word"]), F.array(*[F.lit(w) for w in every]))
    often = dict(texts.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*")).collect())
    order = sorted(every, key=lambda w: (often.get(w, 0), w))
    ranked = {label: [w for w in order if w in s] for label, s in sets.items()}
    rows = [(w, label, ranked[label], len(ranked[label]), need[label], width(templates[label], slack), ranked[label][j:])
            for label in ranked for j, w in enumerate(ranked[label]) if j <= len(ranked[label]) - need[label]]
    index = spark.createDataFrame(rows, "word string, label string, t array<string>, tn int, need int, width int, later array<string>")

    # Only the places of prefix words go on, each with the marks that a block over it can hold.
    widest, prefix = max((r[5] for r in rows), default=0), sorted({r[0] for r in rows})
    at = F.array_compact(F.transform("marks", lambda m, i: F.when(m["word"].isin(prefix), i)))
    around = F.transform(at, lambda i: F.struct(
        F.get("marks", i)["word"].alias("word"), F.get("marks", i)["place"].alias("place"),
        F.slice("marks", F.greatest(i - widest, F.lit(0)) + 1, F.lit(2 * widest + 1)).alias("near")))
    met = texts.select("row", F.inline(around)).join(F.broadcast(index), "word")  # the index has fewer rows than the templates words
    inside = F.col("place").cast("int")
    own = F.filter("near", lambda m: F.array_contains("t", m["word"]) & m["place"].between(inside - F.col("width") + 1, inside + F.col("width") - 1))
    met = met.select("row", "label", "tn", "need", "width", "place", "later", own.alias("own"))

    def distinct(marks: Column) -> Column:
        return F.array_distinct(F.transform(marks, lambda m: m["word"]))

    met = met.where(F.size(distinct(F.col("own"))) >= F.col("need"))
    # Of a block's shared words one is the first in the order, and that one finds it.
    met = met.where(F.size(F.array_intersect(distinct(F.col("own")), "later")) >= F.col("need"))
    blocks = F.transform(F.filter("own", lambda m: m["place"] <= F.col("place")), lambda m: F.size(distinct(
        F.filter("own", lambda x: x["place"].between(m["place"], m["place"] + F.col("width") - 1)))))
    met = met.select("row", "label", "tn", "need", F.array_max(blocks).alias("s")).where(F.col("s") >= F.col("need"))
    return met.groupBy("row", "label").agg(F.max(F.col("s") / F.col("tn")).alias("score"))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, slack: float = SLACK) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of `docs`.

    n_base, first_word, last_word and base_labels tell of the places of PHRASES; labels adds those of the
    templates that some block meets, and score is the largest share of a template's words in such a block, else 0. Null and
    empty texts have no words, no labels ('') and score 0. Texts of any length are gone through whole; what is kept of one are the
    places of the templates' words. Repeated rows are alike, each with its own result. An empty
    table gives no rows. `docs` needs doc_id and text; other columns, whatever their names, aren't read.
    """
    prepared(docs.sparkSession)
    vocabulary = sorted({w for t in [*templates.values(), *PHRASES] for w in t.split()})
    split = docs.select("doc_id", words(F.col("text")).alias("ws"))
    texts = split.select("doc_id", F.size("ws").cast("long").alias("n_words"), marked(F.col("ws"), vocabulary).alias("marks"))
    texts = materialize(texts.withColumn("row", F.monotonically_increasing_id()), "op6-marks")
    found = matches(texts, templates, containment, slack).groupBy("row").agg(F.collect_set("label").alias("found"), F.max("score").alias("score"))

    base = texts.withColumns({f"p{k}": _starts(F.col("marks"), phrase) for k, phrase in enumerate(PHRASES)})
    places = F.concat(*[F.col(f"p{k}") for k in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]))
    base = base.select("row", "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
                       F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"), labels.alias("base"))
    every = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    return base.join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
