"""The registered queries of this package against their oracle statements, and the pipeline against its stages in plain Python."""

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import queries

ORACLES = queries.statements()


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracle(spark, folder, name):
    assert differences(queries.registered()[name](spark, folder), duck(folder), ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered() if n.startswith("op")) == list(range(1, 14))


def test_pipeline_takes_effect(spark, folder):
    """Each stage's rows and texts are what its operator decides on the rows of the stage before."""
    from siltstone.llm import cgk_decontamination, line_chunks, quality_rules, simhash_pigeonring
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(_stored(stage(spark, frames[-1], folder)))
    assert all(f.columns == docs.columns for f in frames[:-1])
    rows = [{r.doc_id: r for r in f.collect()} for f in frames]
    kept = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert rows[1].keys() == kept and 0 < len(kept) < len(rows[0]) and all(rows[1][i] == rows[0][i] for i in kept)
    cut = {r.doc_id: r.text for r in line_chunks.deduplicate(frames[1]).collect()}
    assert {i: r.text for i, r in rows[2].items()} == cut and all(r.n_chars == len(r.text) for r in rows[2].values())
    groups = {}
    for r in simhash_pigeonring.near_duplicates(frames[2]).collect():
        groups.setdefault(r._root, []).append(r.doc_id)
    assert rows[3].keys() == {min(g) for g in groups.values()} and len(rows[3]) < len(rows[2])
    leaks = {r.doc_id for r in cgk_decontamination.contaminations(frames[3], benchmark).collect()}
    assert rows[4].keys() == rows[3].keys() - leaks and leaks
    assert rows[5].keys() == rows[4].keys() and all(r.parity and r.round_trip and r.text == rows[4][i].text for i, r in rows[5].items())
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, folder).collect()} == {i: r.ids for i, r in rows[5].items()}


def _stored(df):
    from siltstone import materialize
    return materialize(df, "stage")


def test_stages_keep_columns_of_any_name(spark, docs, none, folder):
    """Columns named as an operator's results keep their own values, and rows that stay are whole rows."""
    own = {"kept": "mine", "n_lines": 77, "n_words": -1, "n_removed_lines": 5, "class_distance": "far", "_own_0": "zero"}
    given = docs.withColumns({c: F.lit(v) for c, v in own.items()})
    rows = {(r.doc_id, r.id): r for r in given.collect()}
    frame = given
    for name, stage in corpus_pipeline.STAGES[:4]:
        frame = _stored(stage(spark, frame, folder))
        assert frame.columns == given.columns
        for r in frame.collect():
            before = rows[r.doc_id, r.id]
            assert all(r[c] == before[c] for c in given.columns if c not in ("text", "n_chars")) and (r.text == before.text or name != "quality")
    assert 0 < frame.count() < len(rows)
    assert all(stage(spark, none, folder).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_pipeline_on_odd_rows(spark, docs, none, folder):
    for frame in (docs, none):
        for _, stage in corpus_pipeline.STAGES:
            frame = _stored(stage(spark, frame, folder))
        assert "ids" in frame.columns and frame.count() <= docs.count()
