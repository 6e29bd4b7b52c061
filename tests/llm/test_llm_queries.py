"""Registered queries on the whole small tables, against their SQL; the pipeline stage by stage."""

import comparison
import pytest

from cropweave.llm import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(shared, name):
    frame = QUERIES[name](shared, FOLDER)
    got = comparison.rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = comparison.sql_engine(FOLDER).execute(ORACLES[name])
    assert got == comparison.rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_pipeline(shared, documents):
    import corpus_pipeline as pipeline

    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "packing"]
    docs = shared.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        after = pipeline.stage_table(stage(shared, docs, FOLDER))
        assert after.columns == docs.columns and 0 < after.count() <= docs.count(), name
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
    packed = pipeline.STAGES[-1][1](shared, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_stages_take_hard_rows(shared, documents):
    import corpus_pipeline as pipeline

    frame = documents.selectExpr("doc_id", "text", "lang", "'s' AS source", "length(text) AS n_chars")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(shared, frame, FOLDER).columns == frame.columns
        assert stage(shared, frame.limit(0), FOLDER).collect() == []
