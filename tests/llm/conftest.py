import random

import pytest

WORDS = "the of and river stone lamp green to walk seven cloud paper in that music".split()


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Ids and texts: nulls, empty and blank texts, ties, repeated rows, a long text, near copies, shared passages."""
    rng = random.Random(5)
    names = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdglmnrst"]
    base = [prose(rng, 90, names) for _ in range(12)]
    passage = "\n".join(prose(rng, 20, names) for _ in range(6))
    rows = [(None, base[0]), (None, None), (7, None), (8, ""), (9, " \t\n "), (10, "one"), (11, "One"), (12, "one two")]
    rows += [(100 + i, b) for i, b in enumerate(base)]
    rows += [(120, base[3]), (121, base[3]), (121, base[3]), (122, base[4].upper())]
    rows += [(130 + i, base[5].replace(" ", f" zz{i} ", 1)) for i in range(3)]
    rows += [(140 + i, prose(rng, 30, names) + "\n" + passage + "\n" + prose(rng, 30, names)) for i in range(4)]
    rows += [(150, prose(rng, 20_000, names)), (151, "été " * 120), (152, "a" * 60 + "\x00" + "a" * 60), (153, "x\n" * 40),
             (154, "Licensed under the Apache License, Version 2.0.\nAll rights reserved. CC BY cc-by"), (155, "日本語 " * 70)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With columns whose names an operator might use itself."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, label string, d string, th long, id int, _fp long, ids string, h string"
    return spark.createDataFrame([(i, t, (None, "en", "fr")[k % 3], f"s{k % 2}", None if t is None else len(t), None, "l", "d", k, k, 3, "x", "y")
                                  for k, (i, t) in enumerate(texts)], schema)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
