import pytest
from pyspark.sql import functions as F

from cropweave.operators import quality


def test_completeness(spark):
    df = spark.createDataFrame(
        [("A", "Rice", 2015, "PAU", ["Punjab"], ["Drought"], "High", "x", "y", ["t"], "45 q/ha", 120, ["s"]),
         ("A", "Unknown", None, " ", [], None, "Not Specified", "x", None, ["t"], "", 120, [])],
        "variety_name string, crop_type string, year_of_release int, breeding_institution string, recommended_states array<string>, "
        "stressors_tolerated array<string>, stress_tolerance_level string, drought_tolerance string, disease_resistance string, "
        "quality_traits array<string>, yield_performance string, maturity_days int, special_features array<string>")
    got = [r[0] for r in df.select(quality.completeness_score(df)).collect()]
    assert got == [pytest.approx(1.0), pytest.approx(0.5 / 5 + 0.3 / 4 + 0.2 * 2 / 4)]
    assert df.drop("variety_name").select(quality.completeness_score(df.drop("variety_name"))).first()[0] == pytest.approx(0.9)


def test_levels_and_flags(spark):
    df = spark.createDataFrame([(0.95, 3, True), (0.95, 3, None), (0.95, 1, True), (0.7, 2, False), (0.69, 4, True)], "s double, n int, v boolean")
    assert [r[0] for r in df.select(quality.confidence_level("s", "n", "v")).collect()] == ["HIGH", "MEDIUM", "LOW", "MEDIUM", "LOW"]
    assert [r[0] for r in df.select(quality.quality_flag("s", excellent=0.9)).collect()] == ["EXCELLENT"] * 3 + ["MODERATE"] * 2
    assert df.select(quality.composite_quality({"completeness": "s", "expert_verification": F.lit(1.0)})).first()[0] == pytest.approx(0.48)


def test_rules(spark):
    df = spark.createDataFrame([(2015, 120, "q/ha", ["Drought"], "Cereals"), (1950, 300, "bags", ["Hail", "Heat"], "Tea"), (None,) * 5],
                               "y int, m int, u string, s array<string>, c string")
    rules = quality.standard_rules("y", "m", "u", "s", "c")
    assert [r[0] for r in df.select(quality.rule_violations(rules)).collect()] == [[], list(rules), []]


def test_search(spark):
    df = spark.createDataFrame(
        [(1, "Rice", ["Punjab"], ["Drought"], "PAU", 0.9, "GOOD"), (2, "Rice", ["Goa"], ["Heat"], "IARI", 0.4, "Poor"),
         (3, "Wheat", ["Punjab", "Goa"], ["Heat", "Salt"], "IARI", 0.8, "good"), (4, "Rice", None, None, None, None, None)],
        "id int, crop_type string, recommended_states array<string>, stressors_tolerated array<string>, breeding_institution string, "
        "data_completeness_score double, quality_flag string")
    ids = lambda **k: sorted(r.id for r in quality.search_catalogue(df, **k).collect())
    assert ids(crop="Rice") == [1, 2, 4] and ids(state="Punjab") == [1, 3] and ids(stressors=["Heat", "Cold"]) == [2, 3]
    assert ids(min_score=0.5, flags=["Good"]) == [1, 3] and ids(institution="IARI", state="Goa", crop="Wheat") == [3]
    assert ids() == [1, 2, 3, 4]


def test_consistency_and_orphans(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "y", None), (3, "z", 1)], "k int, f string, g int")
    b = spark.createDataFrame([(1, "x", 6), (2, "y", None), (4, "w", 1)], "k int, f string, g int")
    got = {tuple(r) for r in quality.consistency_check(a, b, "k", ["f", "g"]).collect()}
    assert got == {(1, "both", True, False), (2, "both", True, True), (3, "left_only", False, False), (4, "right_only", False, False)}
    assert [r.k for r in quality.orphans(a, b, "k").collect()] == [3]


def test_search_reaches_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([("Rice", ["Goa"], 0.9, "x"), ("Wheat", ["Goa"], 0.9, "x")],
                                 "crop_type string, recommended_states array<string>, data_completeness_score double, note string")
    rows.write.partitionBy("crop_type").parquet(str(tmp_path / "t"))
    found = quality.search_catalogue(spark.read.parquet(str(tmp_path / "t")), crop="Rice", state="Goa", min_score=0.5)
    plan = found.select("crop_type", "recommended_states")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(crop_type" in plan and "GreaterThanOrEqual(data_compl" in plan
    assert "note" not in plan.split("ReadSchema")[1] and found.count() == 1
