import json

import pytest

from cropweave.operators import context as ctx
from cropweave.plans import enrichment

TS = "2024-01-01T00:00:00"


def test_thirty_queries(spark):
    df = spark.createDataFrame([("HD {c} 3226", "wheat"), (None, None)], "variety_name string, crop_name string")
    rows = ctx.search_queries(df).where("crop_name = 'wheat'").orderBy("query_pos").collect()
    assert len(rows) == 30 and ctx.search_queries(df).count() == 60
    kinds = [r.type for r in rows]
    assert kinds.count("google_scholar") == 1 and kinds.count("google_search") == 29
    assert [sum(r.priority == p for r in rows) for p in ("high", "medium", "low")] == [9, 15, 6]
    assert rows[0].query == "HD {c} 3226"
    assert rows[1].query == '"HD {c} 3226" wheat drought tolerance after:2008'
    assert rows[9].query == '"HD {c} 3226" wheat gujarat (blast OR blight OR rust OR bollworm) after:2008'
    assert rows[13].query == 'site:ncbi.nlm.nih.gov "HD {c} 3226" wheat QTL molecular markers'
    assert rows[24].query == 'site:seednet.gov.in "HD {c} 3226" breeder allocation'
    plan = ctx.search_queries(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_year_rule(spark):
    df = spark.createDataFrame([(0, "2007"), (1, "2008"), (2, ""), (3, "2010a"), (4, None), (5, "99999999999")], "i int, y string")
    assert [r[0] for r in df.orderBy("i").select(ctx.is_recent("y")).collect()] == [False, True, False, False, False, False]


def results(spark):
    rows = [("v1", "v1", "google_scholar", i, True, None, f"p{i}", y) for i, y in enumerate(["2007", "2010", "", "2009", "2008", "2020"])]
    web = '"v1" rice heat tolerance after:2008'
    rows += [("v1", web, "google_search", i, True, None, f"w{i:02d}", None) for i in range(14)]
    rows += [("v1", '"v1" rice cold tolerance after:2008', "google_search", 0, False, "timeout", None, None)]
    return spark.createDataFrame(rows, "variety_name string, query string, type string, result_pos int, success boolean, error string, title string, year string")


@pytest.fixture(scope="module")
def contexts(spark):
    varieties = spark.createDataFrame([("v1", "rice"), ("v2", "rice")], "variety_name string, crop_name string")
    return enrichment.compile_context(varieties, results(spark), TS, fields=("title", "year"))


def test_context_documents(contexts):
    docs = {r.variety_info.variety_name: r for r in contexts.collect()}
    entries = docs["v1"].search_results
    assert len(entries) == 30 and [r.title for r in entries[0].results] == ["p1", "p3", "p4"]
    heat = next(e for e in entries if "heat" in e.query)
    assert [r.title for r in heat.results] == [f"w{i:02d}" for i in range(10)] and heat["count"] == 10
    cold = next(e for e in entries if "cold" in e.query)
    assert (cold.success, cold.error, cold["count"]) == (False, "timeout", 0)
    meta = docs["v1"].search_metadata
    assert (meta.total_queries, meta.successful_queries, meta.failed_queries, meta.total_results) == (30, 2, 28, 13)
    assert docs["v2"].search_metadata.failed_queries == 30


def test_split_by_type(contexts):
    row = ctx.split_by_type(contexts).first()
    assert (len(row.google_scholar_results), len(row.google_search_results)) == (1, 29)


def test_first_context_wins_in_any_case(spark):
    varieties = spark.createDataFrame([("PR-124",), ("HD 1",), ("Zed",)], "variety_name string")
    found = spark.createDataFrame([("b.json", 0, "pr-124", "late"), ("a.json", 1, "Pr-124", "second"), ("a.json", 0, "PR-124", "first"),
                                   ("c.json", 0, "hd 1", "only")], "path string, pos int, name string, note string")
    rows = ctx.attach_context(varieties, found, "variety_name", "name", ["path", "pos"]).collect()
    assert {(r.variety_name, r.context.note) for r in rows} == {("PR-124", "first"), ("HD 1", "only")}
    assert [r[0] for r in ctx.without_context(varieties, found, "variety_name", "name").collect()] == ["Zed"]


def test_enriched_records(spark, contexts):
    varieties = spark.createDataFrame([("V1", "rice", "Released"), ("V2", "rice", "Released"), ("v3", "rice", "Released")],
                                      "variety_name string, crop_type string, approval_status string")
    body = json.dumps({"variety_analysis": {"variety_name": "V1"}, "evidence_quality_assessment": {"reliability_score": 7},
                       "stress_tolerance_profile": {"drought_tolerance": {"tolerance_level": "high", "evidence_sources": ["a"]}}})
    replies = spark.createDataFrame([("V1", f"```json\n{body}\n```"), ("V2", "cannot")], "variety_name string, reply_text string")
    from pyspark.sql import functions as F

    rows = {r.original_data.variety_name: r for r in
            enrichment.enrich(varieties, contexts.withColumn("source_path", F.lit("x")), replies, TS).collect()}
    assert sorted(rows) == ["V1", "V2"]
    a = rows["V1"].analysis_result
    assert a.stress_tolerance_profile.drought_tolerance.tolerance_level == "high" and a.error is None
    assert a.evidence_quality_assessment.reliability_score == 7.0
    assert (a.processing_metadata.total_search_queries, a.processing_metadata.successful_queries) == (30, 2)
    assert rows["V2"].analysis_result.error == "reply is not a JSON object"
    assert rows["V1"].context_data.search_metadata.total_results == 13


def test_batches_skip_finished_varieties(spark, tmp_path):
    out = str(tmp_path)
    one = spark.createDataFrame([("v1", "rice")], "variety_name string, crop_name string")
    both = spark.createDataFrame([("v1", "rice"), ("v2", "rice")], one.schema)
    first = enrichment.run_context(one, results(spark), out, TS, 1, ("title", "year"))
    second = enrichment.run_context(both, results(spark), out, TS, 2, ("title", "year"))
    assert [r.variety_info.variety_name for r in first.collect()] == ["v1"]
    assert [r.variety_info.variety_name for r in second.collect()] == ["v2"]
    assert spark.read.json(f"{out}/counters/batch=1").first().total_results == 13
    names = spark.createDataFrame([("V1", "rice"), ("other", "rice")], "variety_name string, crop_type string")
    replies = spark.createDataFrame([("V1", "{}")], "variety_name string, reply_text string")
    contexts = first.selectExpr("*", "'a' as source_path")
    assert enrichment.run_enrichment(names, contexts, replies, out, TS).count() == 1
    assert spark.read.json(f"{out}/without_context/batch=1").first().variety_name == "other"


def test_a_batch_run_again_keeps_what_it_has(spark, tmp_path):
    out = str(tmp_path)
    frame = lambda *names: spark.createDataFrame([(n, "rice") for n in names], "variety_name string, crop_name string")
    enrichment.run_context(frame("v1", "v2"), results(spark), out, TS, 1, ("title", "year"))
    again = enrichment.run_context(frame("v1", "v2", "v3", "v3"), results(spark), out, TS, 1, ("title", "year"))
    assert sorted(r.variety_info.variety_name for r in again.collect()) == ["v1", "v2", "v3"]
    counters = spark.read.json(f"{out}/counters/batch=1").first()
    assert (counters.varieties_processed, counters.total_search_queries) == (3, 90)
    # a run that ended between its documents and its manifest entry
    spark.createDataFrame([], "variety_name string").write.mode("overwrite").parquet(f"{out}/finished")
    assert enrichment.run_context(frame("v1"), results(spark), out, TS, 1, ("title", "year")).count() == 3


def test_one_reply_a_name(spark, contexts):
    varieties = spark.createDataFrame([("V1", "rice")], "variety_name string, crop_type string")
    replies = spark.createDataFrame([("V1", "{}"), ("V1", "no")], "variety_name string, reply_text string")
    from pyspark.sql import functions as F

    assert enrichment.enrich(varieties, contexts.withColumn("source_path", F.lit("x")), replies, TS).count() == 1


def test_payload_is_json(spark, contexts):
    from pyspark.sql import functions as F

    text = contexts.where("variety_info.variety_name = 'v1'").select(
        ctx.analysis_payload(F.struct("search_results"), F.col("variety_info"))).first()[0]
    payload = json.loads(text)
    assert payload["total_queries"] == 30 and payload["successful_queries"] == 2
    assert len(payload["google_scholar_results"]) == 1 and len(payload["google_search_results"]) == 29


def test_counters(spark):
    df = spark.createDataFrame([("a", "google_scholar", True, 3), ("a", "google_search", False, 0), ("b", "google_search", None, 0)],
                               "v string, type string, success boolean, count int")
    assert ctx.run_counters(df, ["v"]).first()[:] == (2, 1, 1, 3, 1, 2, 1, 2, 3)
