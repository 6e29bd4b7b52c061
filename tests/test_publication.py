import json

from pyspark.sql import functions as F

from cropweave.operators import duplicates
from cropweave.plans import publication

GROUPS = [
    ("g1", [("A", "1")], "Unique", 1), ("g2", [("A", "1")] * 2, "Exact Match", 1),
    ("g3", [("A", "1")] * 2 + [("A", "2")] * 2, "Exact Match", 1), ("g4", [("A", "1"), ("A", "2")], "Related but Distinct", 2),
    ("g5", [("A", "1"), ("B", "1")], "Typo/Formatting Issue", 1), ("g6", [("A", "1"), ("A", "1"), ("A", "2")], "Related but Distinct", 3),
    ("g7", [("A", "1"), ("A", "1"), ("B", "2")], "Typo/Formatting Issue", 1), (None, [("A", "1")] * 3, "Unique", 3),
]


def test_duplicate_groups(spark):
    rows = [(k, p, n) for k, members, _, _ in GROUPS for p, n in members]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos long, k string, p string, n string").repartition(5)
    analyzed = duplicates.analyze_duplicates(df, "k", "p", "n", "pos")
    assert analyzed.count() == len(rows)
    got = {(r.k, r.duplicate_category, r.duplicate_match_id) for r in analyzed.collect()}
    ids = {k: i for i, k in enumerate(k for k, m, c, _ in GROUPS if c != "Unique")}
    assert got == {(k, c, ids.get(k, -1)) for k, _, c, _ in GROUPS}
    kept = duplicates.consolidate(analyzed, "pos")
    assert {(r.k, r["count"]) for r in kept.groupBy("k").count().collect()} == {(k, n) for k, _, _, n in GROUPS}
    first = {r.k: r.pos for r in kept.where("duplicate_category in ('Exact Match', 'Typo/Formatting Issue')").collect()}
    assert first == {"g2": 1, "g3": 3, "g5": 9, "g7": 14}
    totals = {r.category: r["rows"] for r in duplicates.duplicate_totals(analyzed).collect()}
    assert totals == {"Unique": 4, "Exact Match": 6, "Related but Distinct": 5, "Typo/Formatting Issue": 5}


def enriched(spark):
    level = lambda v: F.when(F.lit(v is not None), F.struct(
        F.lit(v).alias("tolerance_level"), F.array(F.lit("e1"), F.lit("e2")).alias("evidence_sources")))
    kinds = [level("high" if i == 0 else None if i == 6 else "low").alias(k) for i, k in enumerate(publication.STRESS_TYPES)]
    names = [(1, " him palam DPWO-1", "onion", None), (2, "him palam DPWO-1", "onion", "Released"), (3, "HD 3226", None, "Released"),
             (4, None, "rice", "Released"), (5, None, "rice", "Released")]
    df = spark.createDataFrame(names, "src_pos long, n string, c string, a string")
    return df.select("src_pos", F.struct(F.col("n").alias("variety_name"), F.col("c").alias("crop_type"), F.col("a").alias("approval_status"))
                     .alias("original_data"),
                     F.struct(F.struct(F.col("n").alias("variety_name")).alias("variety_identification"),
                              F.struct(*kinds).alias("stress_tolerance_profile")).alias("analysis_result"))


def test_catalogue(spark, tmp_path):
    published = publication.run(enriched(spark), str(tmp_path), "2024-01-01T00:00:00")
    rows = [r.asDict() for r in published.orderBy("variety_id").collect()]
    assert list(rows[0]) == ["variety_id", *[n for n, _, _ in publication.PUBLISHED]] and len(rows[0]) == 22
    assert [(r["variety_id"], r["variety_name"], r["crop_type"], r["approval_status"]) for r in rows] == [
        ("STS_000001", "Him Palam Dpwo-1", "Onion", "Unknown"), ("STS_000002", "Hd 3226", "Unknown", "Released"),
        ("STS_000003", "Unknown", "Rice", "Released"), ("STS_000004", "Unknown", "Rice", "Released")]
    assert rows[0]["stress_tolerance_drought"] == "high" and rows[0]["genetic_markers"] == "Unknown"
    report = spark.read.json(f"{tmp_path}/summary_report").first()
    assert (report.initial_row_count, report.final_row_count) == (5, 4)
    assert report.duplicate_analysis.asDict() == {"Exact Match": 2, "Unique": 3}
    assert spark.read.json(f"{tmp_path}/database_schema").count() == 22
    assert set(spark.read.schema("missing_column string").json(f"{tmp_path}/missing_columns").toPandas().missing_column) <= set(publication.ESSENTIAL)
    assert spark.read.option("header", True).csv(f"{tmp_path}/initial_data_profile").count() == 3


def test_features_before_or_after_title_case(spark):
    pairs = enriched(spark)
    raw = publication.classify(pairs, "src_pos").where("src_pos = 2").first()
    titled = publication.classify(pairs, "src_pos", features_from="titled").where("src_pos = 2").first()
    assert raw.variety_features.prefix == "DPWO" and titled.variety_features.prefix == "Unknown"


def test_child_table_and_json(spark):
    details = publication.tolerance_details(enriched(spark), "src_pos")
    assert details.count() == 5 * 6
    assert details.where("stress_type = 'drought_tolerance'").first().evidence_source == "e1; e2"
    parents = spark.createDataFrame([(1, "x"), (99, "y")], "variety_id long, variety_name string")
    docs = {r.variety_id: json.loads(r.document) for r in publication.nested_json(parents, details).collect()}
    assert docs[1]["stress_tolerance_details"]["drought_tolerance"] == {"level": "high", "evidence": "e1; e2"}
    assert docs[99] == {"variety_id": 99, "variety_name": "y"}


def test_parent_and_child_tables(spark, tmp_path):
    details = publication.tolerance_details(enriched(spark), "src_pos")
    parents = spark.createDataFrame([(i, f"v{i}") for i in range(1, 5)], "variety_id long, variety_name string")
    parent, child = publication.export_tables(parents, details, str(tmp_path))
    assert parent.count() == 4 and child.count() == 24
    assert [r.tolerance_id for r in child.orderBy("variety_id", "stress_type").collect()] == list(range(1, 25))
    assert spark.read.parquet(f"{tmp_path}/orphans").select("variety_id").distinct().collect()[0][0] == 5
