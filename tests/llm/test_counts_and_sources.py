"""Token counts, source divergence and importance resampling against plain versions, on odd rows and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm import importance, source_audit, token_counts

FILES = "/opt/tokenizers"
ODD = ["", " ", "  ", "a", " a", "a ", "a  b   c ", "a\nb c\n", "<s> a </s><unk> b", "▁a ▁b▁ c d", "été déjà vu 日本語 は 長い", "x" * 300, "a\x00b c\td \r\n e",
       "<|endoftext|> one <|endoftext|>two", "don't stop 12 34 5 it's", "İstanbul  ΑΣ Σ σς", "é é", " a   b", "a b c d e f g " * 40, "🙂 🙂🙂 a🙂 b"]


# --- 11 -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("size", [1, 5, 1 << 20])
def test_segments_keep_the_tokens(name, size, texts):
    with open(f"{FILES}/{name}", "rb") as file:
        data = file.read()
    rng = random.Random(size)
    given = ODD + [t for _, t in texts if t and len(t) < 5000] + ["".join(rng.choices(" \n▁abcté.,'1日", k=60)) for _ in range(200)]
    if name.endswith(".model"):
        plain, kind = sentencepiece.SentencePieceProcessor(model_proto=data).encode, token_counts.PieceLengths
    else:
        own = Tokenizer.from_str(data.decode())
        plain, kind = lambda t: own.encode(t, add_special_tokens=False).ids, token_counts.TokenizerLengths
    lengths = kind(data)
    assert token_counts.count_all(given, lengths, size, 64).tolist() == [len(plain(t)) for t in given]
    if name != "word_bpe_49k.json":  # where a safe place is known, long texts are cut
        assert len(list(token_counts.segments("word and " * 30, lengths, 20))) > 5


def test_token_counts_on_odd_rows(spark, docs, none, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.MODEL)
    rows = [(i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 100) for i, t in texts]
    given = docs.withColumn("n_tokens", F.lit("mine"))
    got = token_counts.count_tokens(given, limit=100)
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and sorted(map(tuple, got.collect()), key=order) == sorted(rows, key=order)
    assert token_counts.count_tokens(given, keep=["doc_id", "lang", "n_tokens"]).columns == ["doc_id", "lang", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts.count_tokens(none).count() == 0
    broken = spark.createDataFrame([(1, b"ab \xff\xfe cd")], "doc_id long, text binary")
    assert token_counts.count_tokens(broken.selectExpr("doc_id", "cast(text as string) as text")).first().n_bytes == 8


# --- 12 -----------------------------------------------------------------------------------------

def plain_audit(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(w for g, _, ws in docs if g == lang for w in set(ws))
        kept = [w for w, n in seen.items() if n >= min_docs]
        counts = defaultdict(Counter)
        for g, source, ws in docs:
            if g == lang:
                counts[source].update(w for w in ws if seen[w] >= min_docs)
        whole = sum(counts.values(), Counter())

        def p(c, own):
            return {w: 1 + 10**9 * (own[w] + 1) // (sum(own.values()) + c) for w in kept}

        prob, q = {s: p(len(kept), own) for s, own in counts.items()}, p(len(kept), whole)
        for s in counts:
            pairs = [(sum((prob[s][w] - prob[h][w]) ** 2 // prob[h][w] for w in kept), h) for h in counts if h != s]
            terms = [((prob[s][w] - q[w]) ** 2 // q[w], w) for w in counts[s] if prob[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("cells", [100_000, 60])
def test_audit_against_plain_version(spark, monkeypatch, cells):
    """More groups than a row block has, several strips, a source with a third of all rows, sources and a language without terms."""
    monkeypatch.setattr(source_audit, "CELLS", cells)
    rng = random.Random(4)
    names = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("l", "m", "né", "日")]
    rows = [(" ".join(rng.choices(names, k=rng.randrange(0, 25))), "en", f"s{rng.randrange(70) if rng.random() < 0.6 else 0}") for _ in range(400)]
    rows += [(" ".join(rng.choices(names[:30], k=9)).upper() + "-_9" * 3, "fr", rng.choice("ab")) for _ in range(30)]
    rows += [(None, "en", "none"), ("", None, None), (None, None, "x"), ("alone", "de", "one"), ("same same", "es", "a"), ("same", "es", "a"), ("same", "es", "b")] + [rows[0]] * 3
    rows += [("z" * 40_000 + " " + " ".join(names * 50), "en", "s1")]
    data = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, rank int, value string").repartition(5)
    assert sorted(map(tuple, source_audit.audit(data, top=7).collect())) == plain_audit(rows, top=7)


def test_audit_of_odd_and_empty_tables(docs, none):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert sorted(map(tuple, source_audit.audit(docs).collect())) == plain_audit(rows)
    assert source_audit.audit(none).count() == 0


def test_audit_arithmetic_is_exact():
    rng = random.Random(6)
    for size in [1, 2, 7, 10**6, 3 * 10**9, 10**14]:
        counts = [0, size - 1, *(rng.randrange(size) for _ in range(50))]
        assert source_audit.probability(np.array(counts), size).tolist() == [1 + 10**9 * (c + 1) // size for c in counts]


def test_empty_quadrants_are_priced():
    """A tree without cells against one with a single cell, and random ones against the plain sum."""
    zero = np.full(source_audit.SIDE, 10)
    single = source_audit.Tree(np.array([3]), np.array([5]), np.array([900]), zero + 2)
    empty = source_audit.Tree(*np.zeros((3, 0), np.int64), zero)
    there, back = source_audit.meet(single, empty, 40), source_audit.meet(empty, single, 40)
    assert there[3, 0] == 39 * (4 // 10) + 890**2 // 10 and there[4, 1] == 40 * (4 // 10) and back[7, 3] == 39 * (4 // 12) + 890**2 // 900
    rng, n = np.random.default_rng(3), source_audit.SIDE
    for filled, width in ((5, n), (40, 7), (700, 50), (n * n, n)):
        trees, plain = [], []
        for _ in range(2):
            cells, base = rng.permutation(n * width)[:filled], rng.integers(1, 50, n)
            values = rng.integers(1, 10**9, len(cells))
            whole = np.repeat(base[:, None], width, 1)
            whole[cells // width, cells % width] = values
            trees.append(source_audit.Tree(cells // width, cells % width, values, base))
            plain.append(whole)
        assert (source_audit.meet(*trees, width) == source_audit.divergence(plain[0][:, None], plain[1][None]).sum(2)).all()


# --- 13 -----------------------------------------------------------------------------------------

def plain_resample(rows, target, settings):
    def features(text):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(found[i:i + n]) for n in range(1, settings.longest + 1) for i in range(len(found) - n + 1)]
        return len(found), [zlib.crc32(r.encode()) % settings.buckets for r in runs]

    own, other = [features(t) for _, t in rows], Counter(b for t in target for b in features(t)[1])
    here, m = Counter(b for _, f in own for b in f), settings.buckets
    s_all, t_all = float(here.total()), float(other.total())
    gain = {b: math.floor(1000 * math.log((other[b] + 1.0) * (s_all + m) / ((here[b] + 1.0) * (t_all + m)))) for b in here}
    out = []
    for (i, _), (n, f) in zip(rows, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{settings.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    fit = sorted((r for r in out if r[5] >= settings.min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(fit[:settings.percent * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("settings", [importance.Settings(), importance.Settings(longest=3, buckets=50, min_words=1, percent=60, seed="x")])
def test_resampling_against_plain_version(spark, docs, texts, settings):
    target = [t for _, t in texts[8:12]] + [None, ""]
    there = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = importance.resample(docs.withColumn("rank", F.lit("mine")).repartition(4), there, settings)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4] or 0)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain_resample(texts, target, settings), key=order)


def test_resampling_of_empty_tables(docs, none):
    assert importance.resample(none, docs).count() == 0
    assert importance.resample(docs, none).count() == docs.count()
    assert [r.rank for r in importance.resample(docs.where("text = ''"), docs).collect()] == [None]


def test_resampling_prefers_the_target(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["lamp", "stone", "river"] if i % 2 else ["qq", "ww", "river"], k=30))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = importance.resample(docs, docs.where("doc_id % 2 = 1").limit(20)).where("rank is not null").collect()
    assert len(drawn) == 40 and sum(r.doc_id % 2 for r in drawn) > 30 and sorted(r.rank for r in drawn) == list(range(1, 41))
