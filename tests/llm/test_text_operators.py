"""Each operator on odd rows and on empty tables, against a plain version where it has one result."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltstone.llm import (
    bloom,
    bloom_lm,
    cgk_decontamination,
    classifier_chain,
    components,
    license_join,
    line_chunks,
    quality_rules,
    sentencepiece_backend,
    simhash_pigeonring,
    splitter_shards,
    suffix_dedup,
)


def key(row):
    return (row[0] is not None, row[0] or 0, *map(str, row[1:]))


def utf8(text):
    return (text or "").encode()


# --- 1 ------------------------------------------------------------------------------------------

def test_chain_learns_categories_and_stems(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        junk, toxic = rng.random() < 0.3, rng.random() < 0.3
        words = [rng.choice("lamp stone river cloud paper".split()) for _ in range(rng.randrange(5, 40))]
        words += [rng.choice(["qqq", "www"])] * junk + ["grumb" + rng.choice("abcdefghijklmnop")] * toxic
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(junk), int(toxic), int(junk and toxic)))
    data = spark.createDataFrame(rows, "doc_id long, text string, junk int, toxic int, both int")
    chain = classifier_chain.fit(data.where("doc_id < 600"), ["junk", "toxic", "both"])
    assert [m.numFeatures - chain.models[0].numFeatures for m in chain.models] == [0, 1, 2]  # earlier probabilities
    found = classifier_chain.score(data.where("doc_id >= 600"), chain).join(data, "doc_id").collect()
    for category in chain.categories:
        assert sum(r[f"is_{category}"] == r[category] for r in found) >= 0.97 * len(found)


def test_chain_against_plain_arithmetic(spark, docs, texts):
    """Vocabulary by (count, term), whatever the partitions; each probability from words, stems and the earlier probabilities."""
    rng, names = random.Random(7), "lamp stone river cloud paper grumble".split()
    rows = [(i, " ".join(rng.choices(names, k=6)) + f" tie{i % 40}", int(i % 3 == 0), int(i % 5 == 0)) for i in range(400)]
    data = spark.createDataFrame(rows, "doc_id long, text string, a int, b int")
    training = classifier_chain.Training(vocabulary=20)
    chains = [classifier_chain.fit(data.repartition(n), ["a", "b"], training) for n in (1, 7)]

    def terms(text):
        ws = set(re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        return {"\n"} | ws | {w[:4] + "*" for w in ws if len(w) > 4}
    often = Counter(t for _, text, *_ in rows for t in terms(text))
    assert chains[0].terms.vocabulary == chains[1].terms.vocabulary == sorted(often, key=lambda t: (-often[t], t))[:20]
    chain = chains[0]
    got = {r.doc_id: r for r in classifier_chain.score(docs, chain).collect() if r.doc_id is not None}
    for i, text in texts:
        if i is not None:
            x = [float(t in terms(text)) for t in chain.terms.vocabulary]
            for name, model in zip(chain.categories, chain.models, strict=True):
                z = model.intercept + sum(w * v for w, v in zip(model.coefficients.toArray(), x, strict=True))
                x.append(1 / (1 + math.exp(-z)))
                assert got[i][f"p_{name}"] == pytest.approx(x[-1]) and got[i][f"is_{name}"] == (got[i][f"p_{name}"] >= 0.5)


def test_earlier_probabilities_are_out_of_fold(spark):
    """A first category that can't be learned from words gives, out of fold, probabilities that tell nothing of it: the second model,
    whose category equals the first, mustn't trust them as it would trust fitted ones."""
    rng = random.Random(3)
    rows = [(i, f"own{i} " * 3, y := rng.randrange(2), y) for i in range(300)]
    data = spark.createDataFrame(rows, "doc_id long, text string, a int, b int")
    chain = classifier_chain.fit(data, ["a", "b"], classifier_chain.Training(min_documents=1))
    assert abs(chain.models[1].coefficients.toArray()[-1]) < 10 and chain.models[0].numFeatures + 1 == chain.models[1].numFeatures


def test_chain_on_odd_rows_and_without_labels(spark, docs, none):
    labels = docs.withColumns({"toxic": F.when(F.col("doc_id") % 2 == 0, 1), "junk": F.lit(None).cast("int")})
    chain = classifier_chain.fit(labels, ["junk", "toxic"])
    assert classifier_chain.score(docs, chain).count() == docs.count() and classifier_chain.score(none, chain).count() == 0
    empty = classifier_chain.fit(labels.limit(0), ["junk", "toxic"])
    assert {(r.p_toxic, r.is_toxic) for r in classifier_chain.score(docs, empty).collect()} == {(None, False)}


# --- 2 ------------------------------------------------------------------------------------------

def test_quality_base_counts(docs, none, texts):
    got = sorted(map(tuple, quality_rules.judge(docs).drop("class_distance", "word_distance", "kept").collect()), key=key)
    expected = []
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {p + k for p, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
                         len(words) < 50 or 100 * len(covered) > 50 * len(words)))
    assert got == sorted(expected, key=key)
    assert quality_rules.judge(none).count() == 0


def test_divergent_texts_go_and_short_ones_are_guarded(spark):
    rng = random.Random(1)
    plain = [(i, " ".join(rng.choice("the of and river stone lamp green".split()) + str(rng.randrange(3)) * 0 + rng.choice(["", "s", "ed", "ing"]) for _ in range(120)), "en") for i in range(60)]
    odd = [(100, " ".join(f"##{i}%%" for i in range(120)), "en"), (101, " ".join(w.upper() + "!!" for w in plain[0][1].split()), "en"), (102, "%% ## " * 3, "en")]
    found = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(plain + odd, "doc_id long, text string, lang string")).collect()}
    assert not any(found[i].kept for i in (100, 101)) and not found[100].base_failed
    assert found[102].class_distance is None and found[102].word_distance is None
    assert all(found[i].kept or found[i].base_failed for i in range(60))


@pytest.mark.parametrize("most", [1000, 1])
def test_small_languages_are_judged(spark, monkeypatch, most):
    """A language far below a thousandth of all words, with its reference broadcast or joined."""
    monkeypatch.setattr(quality_rules, "BROADCAST", most)
    rng, names = random.Random(3), [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "dglmnr"]
    rows = [(i, " ".join(rng.choices(names, k=10_000)), "en") for i in range(100)]
    rows += [(200 + i, " ".join(rng.choices(names[:20], k=60)), "xx") for i in range(12)] + [(300, " ".join(f"##{i}%%" for i in range(60)), "xx")]
    rows += [(400, None, "yy"), (401, " ".join(rng.choices(names, k=60)), None)]
    found = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()}
    assert len(found) == len(rows) and not found[300].kept and not found[300].base_failed
    assert all(found[200 + i].word_distance is not None and found[200 + i].class_distance < 0.3 for i in range(12)) and found[401].word_distance < 1e-6


def test_distance():
    assert quality_rules.distance(np.array([1, 0.0]), np.array([0, 5.0])) == 1 and quality_rules.distance(np.array([2, 6.0]), np.array([1, 3.0])) == 0


# --- 3 ------------------------------------------------------------------------------------------

def test_shards(docs, none, texts):
    rows = splitter_shards.shard(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len(utf8(t)) + 1, zlib.crc32(utf8(t))) for i, t in texts)
    slots = {}
    for r in rows:
        assert 0 <= r.shard < 8 and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert splitter_shards.shard(none).count() == 0


def test_shards_are_even_also_with_a_third_in_one_text(spark):
    rng = random.Random(4)
    rows = [(i, "same text" if i % 3 == 0 else "x" * rng.randrange(200)) for i in range(6000)]
    found = splitter_shards.shard(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    mean = sum(r.b for r in found) / 8
    assert len(found) == 8 and all(abs(r.b / mean - 1) < 0.05 for r in found)


def test_equal_rows_are_parted(spark):
    found = splitter_shards.shard(spark.createDataFrame([(1, "same")] * 4000, "doc_id long, text string")).groupBy("shard").count().collect()
    assert len(found) == 8 and max(r["count"] for r in found) < 600


# --- 4 ------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, none, texts):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash_pigeonring.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t) for _, t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    least = {}
    for r, (i, _) in zip(root, texts, strict=True):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    assert got == {(i, f"{p:016x}", least[r]) for (i, _), p, r in zip(texts, prints, root, strict=True)}
    assert simhash_pigeonring.near_duplicates(none).count() == 0


@pytest.mark.parametrize("crowd", [2, 32])
def test_links_reach_all_within_two_bits(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash_pigeonring, "CROWD", crowd)
    rng, values = random.Random(crowd), set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        values |= {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(25)}
    values |= {0, (1 << 64) - 1, 1 << 63, 3 << 62}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash_pigeonring.links(spark.createDataFrame([(v,) for v in signed], "_fp long")).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in links)

    def groups(pairs):
        root = {v: v for v in signed}

        def top(v):
            while root[v] != v:
                v = root[v]
            return v
        for a, b in pairs:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
        return {v: top(v) for v in signed}
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert groups([(r.a, r.b) for r in links]) == groups(near)


def test_one_of_each(docs):
    kept = simhash_pigeonring.one_of_each(docs)
    assert kept.columns == docs.columns
    roots = simhash_pigeonring.near_duplicates(kept).select("_root").collect()
    assert len(roots) == len(set(roots)) == simhash_pigeonring.near_duplicates(docs).select("_root").distinct().count()


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "x int, y int"), "x", "y").collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)}
    assert components.components(spark.createDataFrame([], "x int, y int"), "x", "y").count() == 0


# --- 5 ------------------------------------------------------------------------------------------

def test_line_chunks(docs, none, texts):
    def chunks(text):
        lines = text.split("\n")
        hashes = [0, 0] + [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        starts = [0] + [i for i in range(1, len(lines)) if (hashes[i] * 31 + hashes[i + 1]) % 3 == 0]
        return [(a, lines[a:b]) for a, b in zip(starts, starts[1:] + [len(lines)], strict=True)]
    first = {}
    for i, t in texts:
        for start, part in chunks(t or ""):
            if sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in part) >= 2:
                place = (i is not None, i or 0, "" if t is None else t, start)
                first[tuple(part)] = min(first.get(tuple(part), place), place)
    expected = []
    for i, t in texts:
        kept = [x for start, part in chunks(t or "")
                if first.get(tuple(part), ((i is not None), i or 0, "" if t is None else t, start)) == (i is not None, i or 0, "" if t is None else t, start) for x in part]
        gone = len((t or "").split("\n")) - len(kept)
        expected.append((i, t if not gone else "\n".join(kept), gone))
    out = line_chunks.deduplicate(docs)
    assert out.columns == docs.columns + list(line_chunks.COUNTS)
    got = sorted(map(tuple, out.select("doc_id", "text", "n_removed_lines").collect()), key=key)
    assert got == sorted(expected, key=key) and sum(e[2] for e in expected) > 5
    assert line_chunks.deduplicate(none).count() == 0


# --- 6 ------------------------------------------------------------------------------------------

def plain_licenses(text, templates=license_join.TEMPLATES, containment=license_join.CONTAINMENT):
    """Words, starts of the base phrases by label, and the best share of each template in a block, in plain Python."""
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts = {label: [i for i in range(len(ws)) if ws[i:i + len(p.split())] == p.split()] for p, label in license_join.PHRASES.items()}
    found = {}
    for label, t in templates.items():
        own, n = set(t.split()), license_join.width(t)
        best = max((len(own.intersection(ws[i:i + n])) for i in range(len(ws))), default=0)
        if best >= math.ceil(containment * len(own) - 1e-9):
            found[label] = best / len(own)
    return ws, {k: v for k, v in starts.items() if v}, found


def test_licenses_on_odd_rows(docs, none, texts):
    def expected(i, text):
        ws, starts, found = plain_licenses(text)
        places = sorted(p for v in starts.values() for p in v)
        return (i, len(ws), len(places), places[0] if places else None, places[-1] if places else None, ",".join(sorted(starts)),
                ",".join(sorted(starts.keys() | found.keys())), max(found.values(), default=0.0))
    got = license_join.scan(docs)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(i, t) for i, t in texts), key=key)
    assert license_join.scan(none).count() == 0


def test_licenses_in_any_layout(spark):
    """Wrapped notices, notices with a few words changed and notices in very long lines are found; scattered words are none."""
    rng, names = random.Random(9), [f"{a}{b}" for a in "bdfgk" for b in "aeiou"]
    rows, expected = [], {}
    for label, t in license_join.TEMPLATES.items():
        ws = t.split()
        wrapped = "\n * ".join(" ".join(ws[i:i + 4]) for i in range(0, len(ws), 4))
        rows += [(len(rows), " ".join(rng.choices(names, k=40)) + "\n" + wrapped + ".\n" + " ".join(rng.choices(names, k=40)))]
        expected[rows[-1][0]] = label
        rows += [(len(rows), " ".join(rng.choices(names, k=3000)) + " " + t.upper() + " " + " ".join(rng.choices(names, k=3000)))]
        expected[rows[-1][0]] = label
        if len(set(ws)) > 12:
            changed = [w if k != len(ws) // 2 else "zzz qqq" for k, w in enumerate(ws)]
            rows += [(len(rows), " ".join(changed))]
            expected[rows[-1][0]] = label
        rows += [(len(rows), " ".join(w + " " + " ".join(rng.choices(names, k=60)) for w in ws))]
    found = {r.doc_id: r for r in license_join.scan(spark.createDataFrame(rows, "doc_id int, text string").repartition(3)).collect()}
    for i, text in rows:
        assert (found[i].score, found[i].labels) == (max(plain_licenses(text)[2].values(), default=0.0), ",".join(sorted({**plain_licenses(text)[1], **plain_licenses(text)[2]})))
        assert expected[i] in found[i].labels.split(",") if i in expected else found[i].score == 0


def test_similarity_join_is_exact(spark):
    rng, words = random.Random(6), [f"w{i}" for i in range(14)]
    templates = {f"t{k}": " ".join(rng.choices(words, k=rng.randrange(1, 10))) for k in range(8)}
    rows = [(i, [rng.choice([*words, "x", "y"]) for _ in range(rng.randrange(1, 40))]) for i in range(300)]
    data = spark.createDataFrame(rows, "row int, ws array<string>").select("row", license_join.marked(F.col("ws"), words).alias("marks"))
    for share in (0.5, 0.8, 1.0):
        got = {(r.row, r.label): r.score for r in license_join.matches(data, templates, share).collect()}
        assert got == {(i, k): s for i, ws in rows for k, s in plain_licenses(" ".join(ws), templates, share)[2].items()}


# --- 7 ------------------------------------------------------------------------------------------

def test_suffix_order():
    rng = random.Random(3)
    for _ in range(150):
        alphabet = rng.choice([b"ab", bytes(range(256)), b"a", b"\x00\x01", b"\x00a"])
        text, depth = bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))), rng.choice([3, 5, 50])
        order = suffix_dedup.suffix_order(np.frombuffer(text, np.uint8), depth).tolist()
        assert sorted(order) == list(range(len(text))) and [text[i:i + depth] for i in order] == sorted(text[i:i + depth] for i in order)


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 100])
def test_suffix_dedup(docs, none, texts, crowd):
    first, expected = {}, []
    place = {n: (n is not None, n or 0) for n, _ in texts}
    for i, t in texts:
        for at in range(len(utf8(t)) - 49):
            window = utf8(t)[at:at + 50]
            first[window] = min(first.get(window, place[i]), place[i])
    for i, t in texts:
        data = utf8(t)
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at:at + 50]] < place[i]:
                gone[at:at + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        expected.append((i, len(data), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    got = sorted(map(tuple, suffix_dedup.deduplicate(docs, crowd).drop("kept").collect()), key=key)
    assert got == sorted(expected, key=key) and sum(e[2] > 0 for e in expected) > 6
    assert suffix_dedup.deduplicate(none).count() == 0


# --- 8 ------------------------------------------------------------------------------------------

def test_scores(docs, none, texts):
    rows = [(i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, bloom_lm.tokens(t)) for i, t in texts]
    counts = Counter(w for _, held, x in rows if not held for w in x)
    pairs = Counter(p for _, held, x in rows if not held for p in zip([b"\t"] + x, x, strict=False))
    total, below = counts.total(), counts.total() + 0.5 * (len(counts) + 1)
    began = sum(not held for _, held, _ in rows)

    def mean(n):
        return float(bloom_lm.MEANS[n.bit_length()])
    expected = []
    for i, held, x in rows:
        base = sum(math.log10((counts[w] + 0.5) / below) for w in x)
        score = 0.0
        for v, w in zip([b"\t"] + x, x, strict=False):
            before = mean(began if v == b"\t" else counts[v])
            score += math.log10((min(mean(pairs[v, w]), before) + 2 * (mean(counts[w]) + 0.5) / below) / (before + 2))
        expected.append((i, held, len(x), sum(counts[w] > 0 for w in x), total, base, score))
    for frequent in (200_000, 5):
        got = sorted(map(tuple, bloom_lm.score(docs, bloom_lm.Model(frequent=frequent)).collect()), key=lambda r: key(r[:3]))
        for g, e in zip(got, sorted(expected, key=lambda r: key(r[:3])), strict=True):
            assert g[:5] == e[:5] and g[5] == pytest.approx(e[5]) and g[6] == pytest.approx(e[6], rel=0.05, abs=0.2)
    assert bloom_lm.score(none).count() == 0


def test_scores_of_many_batches(docs, monkeypatch):
    """Batches of a few documents share their n-grams: counts come from all of them, and scores don't depend on how texts are dealt."""
    def found(df):
        return sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in bloom_lm.score(df).collect()), key=key)
    whole = found(docs.coalesce(1))
    monkeypatch.setattr(bloom_lm, "BATCH", 2000)
    assert found(docs.repartition(7)) == whole and len(whole) > 30


def test_blocks_keep_their_bits_for_each_key():
    """No n-gram is missed at any size; false levels stay about as rare; a block without n-grams has none."""
    rng = np.random.default_rng(2)
    for n in (0, 3, 3_000, 300_000):
        keys = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)
        most = bloom_lm.levels(rng.geometric(0.5, n))
        block = bloom_lm.Block.of(keys, most)
        assert (block.probe(keys) >= most).all() and len(block.data) <= max(8, bloom_lm.BITS * most.sum() // 8)
        assert n < 100 or ((block.probe(keys) > most).mean() < 0.02 and (block.probe(keys + np.uint64(1)) > 0).mean() < 0.02)


def test_planes_round_trip():
    for kind in (np.uint32, np.uint64):
        values = np.array([0, 1, 255, 256, 2**32 - 1], kind)
        assert (bloom_lm._numbers(bloom_lm._planes(values), kind) == values).all() and len(bloom_lm._numbers(b"", kind)) == 0


def test_filter_grows_with_its_keys():
    """At every size the share of false levels stays about that of 10 bits for each key."""
    rng = np.random.default_rng(2)
    for n in (3_000, 300_000):
        keys = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)
        bits = bloom.bits_for(n)
        words = np.zeros(1 << bits - 3, np.uint8)
        for spot in bloom.spots(keys, bits):
            np.bitwise_or.at(words, spot >> np.uint64(3), np.uint8(1) << (spot & np.uint64(7)).astype(np.uint8))
        single = bloom.Bloom(words, bits, 0)
        assert single.has(keys).all() and single.has(keys + np.uint64(1)).mean() < 0.02


def test_bloom_has_no_false_negative(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000, np.uint64) * np.uint64(2)
    bits = bloom.size_for(len(keys), 1 << 20)
    rows = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long").repartition(8, F.shiftright("key", 64 - bloom.BLOCK_BITS))
    filled = bloom.Bloom(bloom.collect(rows, bits, lambda b: b.column(0).to_numpy().view(np.uint64)), bits)
    assert filled.has(keys).all() and filled.has(keys + np.uint64(1)).mean() < 0.05


# --- 9 ------------------------------------------------------------------------------------------

def plain_edits(item, run):
    row = [0] * (len(run) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(run, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[-1] + 1))
    return min(row)


def test_decontamination_against_brute_force(spark, docs, none):
    rng = random.Random(8)
    names = [f"{a}{b}{c}" for a in "bdfgklmnpr" for b in "aeiou" for c in "bdglmnrst"]
    items = [[rng.choice(names[:150]) for _ in range(rng.randrange(8, 40))] for _ in range(25)]
    rows = []
    for k in range(160):
        item, edits = rng.choice(items), rng.choice([0, 0.1, 0.2, 0.3])
        text = list(item)
        for _ in range(int(edits * len(item))):
            at = rng.randrange(len(text))
            text[at:at + 1] = rng.choice([[], [rng.choice(names)], [text[at], rng.choice(names)]])
        rows.append((k, " ".join([*rng.choices(names, k=rng.randrange(30)), *text, *rng.choices(names, k=rng.randrange(30))]).title()))
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (91, ""), (92, "too short")], "item_id int, text string")
    search = cgk_decontamination.Search()
    got = {(r.doc_id, r.item_id): r.n_edits for r in cgk_decontamination.contaminations(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()}
    want = {}
    for k, t in rows:
        words = t.lower().split()
        for i, item in enumerate(items):
            if (edits := plain_edits(item, words)) <= search.edits(len(item)):
                want[k, i] = edits
    assert got.items() <= want.items() and len(got) >= 0.9 * len(want) and len(want) > 80
    assert all(got[k] == 0 for k, e in want.items() if e == 0)  # exact passages are never missed
    assert cgk_decontamination.contaminations(docs, benchmark).count() == 0 and cgk_decontamination.contaminations(none, benchmark).count() == 0
    assert cgk_decontamination.contaminations(docs, benchmark.limit(0)).count() == 0
    blocks = cgk_decontamination.contaminations(spark.createDataFrame(rows[:40], "doc_id long, text string"), benchmark, cgk_decontamination.Search(block_items=9))
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} >= {k for k, e in want.items() if k[0] < 40 and e == 0}


def test_short_repeated_and_very_long_items(spark):
    """Short items are found word by word; equal items once under each id; an item of very many words with a few edits, beside short texts."""
    rng, names = random.Random(12), [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "dglmnr"]
    long = rng.choices(names, k=800)
    items = [(1, "zip zap"), (2, "Zip, zap!"), (3, "zop"), (4, " ".join(long)), (5, " ".join(long)), (6, "..."), (7, None), (8, " ".join(names[:9])), (9, "zip zap zup")]
    worn = [w for k, w in enumerate(long) if k % 100] + ["tail"]
    rows = [(1, "so zip zap and zip zap"), (2, "zip a zap"), (3, " ".join(["head", *worn])), (4, " ".join(rng.choices(names, k=40))), (5, None), (6, ""),
            (7, "x " + " ".join(names[:9]).upper()), (8, "zip zap zup zop")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for search in (cgk_decontamination.Search(), cgk_decontamination.Search(block_items=2), cgk_decontamination.Search(block_bytes=100)):
        found = sorted(map(tuple, cgk_decontamination.contaminations(docs, benchmark, search).collect()))
        assert [f for f in found if f[0] != 3] == [(1, 1, 1, 2, 0), (1, 2, 1, 2, 0), (7, 8, 1, 9, 0), (8, 1, 0, 2, 0), (8, 2, 0, 2, 0), (8, 3, 3, 1, 0), (8, 9, 0, 3, 0)]
        assert [(f[1], f[4]) for f in found if f[0] == 3] == [(4, 8), (5, 8)]


# --- 10 -----------------------------------------------------------------------------------------

ODD = ["", " ", "  a  b ", "a\n\n b\t", "▁▁x ▁", "<s>hi</s> <0x0A> <unk>", "日本語 \U0001F600", "é" * 300, "\x00a", " leading", "trail  ", "　 \xa0x", "a" * 500]


def own_model(kind, byte_fallback=True, **norm):
    """A small model, written by hand: no tokenizer is trained."""
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = kind, byte_fallback
    proto.normalizer_spec.add_dummy_prefix = proto.normalizer_spec.escape_whitespaces = True
    proto.normalizer_spec.remove_extra_whitespaces = norm.get("squeeze", False)
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else []
    words = ["▁", "a", "b", "c", "d", "e", "ab", "▁a", "▁ab", "bc", "abc", "▁abc", "de", "cd", "▁▁", "ea", "dea"]
    for piece, score, type_ in pieces + [(w, -1.0 - 0.37 * i, 1) for i, w in enumerate(words)]:
        proto.pieces.add(piece=piece, score=score, type=type_)
    return proto.SerializeToString()


@pytest.mark.parametrize("data", [open(sentencepiece_backend.MODEL, "rb").read(), own_model(1), own_model(2), own_model(2, squeeze=True), own_model(1, byte_fallback=False)],
                         ids=["public", "unigram", "bpe", "squeeze", "no bytes"])
def test_parity_with_sentencepiece(data, texts):
    import sentencepiece
    rng = random.Random(1)
    samples = ODD + [t for _, t in texts if t] + ["".join(rng.choice("abcde  xé\n") for _ in range(rng.randrange(60))) for _ in range(300)]
    if sentencepiece_backend.read_model(data).normalizer_spec.remove_extra_whitespaces:  # there a written marker counts as a space at the ends
        samples = [s for s in samples if sentencepiece_backend.MARK not in s]
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data).encode(samples)
    tokenizer = sentencepiece_backend.build(data)
    assert [e.ids for e in tokenizer.encode_batch(samples, add_special_tokens=False)] == theirs
    ids, back, same = sentencepiece_backend.Encoder(data, tokenizer.to_str()).encode(samples)
    assert [np.frombuffer(i, "<i4").tolist() for i in ids] == theirs and all(same)
    assert back == [t == s for t, s in zip(tokenizer.decode_batch(theirs, skip_special_tokens=False), samples, strict=True)]


def test_tokenize(docs, none, texts):
    out = sentencepiece_backend.tokenize(docs)
    assert out.columns == [c for c in docs.columns if c != "ids"] + list(sentencepiece_backend.COUNTS)
    rows = out.collect()
    assert len(rows) == len(texts) and all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (7, 8)} == {0} and sentencepiece_backend.tokenize(none).count() == 0
