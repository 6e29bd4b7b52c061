import itertools
import random

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from cropweave.operators import counts, stats
from cropweave.plans import reports

CROPS, PLACES, TRAITS = ["RICE", "WHEAT", "ONION", "COTTON"], ["IARI", "AAU", "NRC"], ["Drought", "Heat", "Rust", "Salt", "Wilt"]


@pytest.fixture(scope="module")
def pdf():
    rng = random.Random(9)
    maybe = lambda v: None if rng.random() < 0.15 else v
    some = lambda pool: rng.sample(pool, rng.randint(0, 4))
    return pd.DataFrame([{
        "variety_name": f"v{i % 150}", "crop_type": maybe(rng.choice(CROPS)), "breeding_institution": maybe(rng.choice(PLACES)),
        "year_of_release": maybe(rng.randint(1975, 2024)), "maturity_days": maybe(rng.randint(60, 340)),
        "data_completeness_score": maybe(round(rng.random(), 3)), "quality_flag": maybe(rng.choice(["GOOD", "Good", "POOR"])),
        "confidence_level": maybe(rng.choice(["High", "LOW"])), "stressors_tolerated": some(TRAITS), "quality_traits": some(TRAITS),
        "recommended_states": some(["Punjab", "Goa", "Bihar", "Assam"]), "data_sources": some(["a", "b", "c", "d"])} for i in range(300)])


@pytest.fixture(scope="module")
def catalogue(spark, pdf):
    schema = ("variety_name string, crop_type string, breeding_institution string, year_of_release int, maturity_days int, "
              "data_completeness_score double, quality_flag string, confidence_level string, stressors_tolerated array<string>, "
              "quality_traits array<string>, recommended_states array<string>, data_sources array<string>")
    rows = [tuple(None if not isinstance(v, list) and pd.isna(v) else int(v) if c in ("year_of_release", "maturity_days") else v
                  for c, v in r.items()) for r in pdf.to_dict("records")]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="module")
def all_reports(catalogue):
    return reports.profile_catalogue(catalogue)


def pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_every_report_runs(all_reports):
    for name, frame in all_reports.items():
        assert frame.count() > 0 or name == "strong_pairs", name


def test_describe(all_reports, pdf):
    for r in all_reports["describe"].collect():
        want = pdf[r.column_name].astype(float).describe()
        got = [r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]]
        assert got == pytest.approx(list(want))


def test_missing(all_reports, pdf):
    want = pdf.isnull().sum()
    assert pairs(all_reports["missing"], "column_name", "missing_count", "missing_percentage") == {
        (c, n, round(n / 300 * 100, 2)) for c, n in want.items() if n}


def test_value_counts(all_reports, pdf):
    assert pairs(all_reports["crops"], "crop_type", "count") == set(pdf.crop_type.value_counts().items())
    stress = pdf.stressors_tolerated.explode().value_counts()
    assert pairs(all_reports["stressors"], "stress", "count") == set(stress.items())
    sizes = pdf.stressors_tolerated.map(len).value_counts()
    assert pairs(all_reports["stressor_sizes"], "size", "count") == set(sizes.items())


def test_crosses(all_reports, pdf, catalogue):
    long = pdf.explode("stressors_tolerated")
    want = pd.crosstab(long.stressors_tolerated, long.crop_type)
    cells = {(s, c, want.loc[s, c]) for s, c in itertools.product(want.index, want.columns)}
    assert pairs(all_reports["stress_by_crop"], "stress", "crop_type", "count") == {x for x in cells if x[2]}
    assert pairs(all_reports["stress_by_crop_top"], "stress", "crop_type", "count") == cells
    wide = counts.cross_table(all_reports["stress_by_crop"], "stress", "crop_type", CROPS).collect()
    assert {(r.stress, c, r[c]) for r in wide for c in CROPS} == cells


@pytest.mark.parametrize("report, column, bins", [("maturity_histogram", "maturity_days", 15), ("completeness_histogram", "data_completeness_score", 20)])
def test_histograms(all_reports, pdf, report, column, bins):
    want, edges = np.histogram(pdf[column].dropna().astype(float), bins=bins)
    rows = all_reports[report].orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(want)
    assert [r.bin_start for r in rows] == pytest.approx(list(edges[:-1]))


def test_histogram_of_a_constant(spark):
    rows = counts.histogram(spark.createDataFrame([(5,), (5,), (None,)], "x int"), "x", 3).orderBy("bin").collect()
    want, edges = np.histogram([5.0, 5.0], bins=3)
    assert [r["count"] for r in rows] == list(want) and rows[0].bin_start == edges[0]
    assert counts.histogram(spark.createDataFrame([(None,)], "x int"), "x", 3).count() == 0


def test_correlations(all_reports, pdf):
    numbers = ["year_of_release", "maturity_days", "data_completeness_score"]
    want = pdf[numbers].astype(float).corr()
    for r in all_reports["correlations"].collect():
        assert r.correlation == pytest.approx(want.loc[r.column_a, r.column_b])
    holes = pdf.isnull().astype(int).corr()
    for r in all_reports["missing_correlations"].collect():
        w = holes.loc[r.column_a, r.column_b]
        assert r.correlation is None if np.isnan(w) else r.correlation == pytest.approx(w)


def test_trends(all_reports, pdf):
    years = pdf.year_of_release.dropna()
    assert pairs(all_reports["years"], "year_of_release", "count") == set(years.astype(int).value_counts().items())
    assert pairs(all_reports["decades"], "decade", "count") == set((years // 10 * 10).astype(int).astype(str).add("s").value_counts().items())
    recent = pdf[pdf.year_of_release >= 2010].crop_type.value_counts()
    assert pairs(all_reports["recent_crops"], "crop_type", "count") == set(recent.items())
    diverse = pdf.groupby("breeding_institution").crop_type.nunique()
    assert pairs(all_reports["institution_diversity"], "breeding_institution", "count") == set(diverse.items())


def test_specialists(all_reports, pdf):
    want = set()
    for crop in CROPS:
        top = pdf[pdf.crop_type == crop].breeding_institution.value_counts()
        want |= {(crop, inst, n) for inst, n in sorted(top.items(), key=lambda x: (-x[1], x[0]))[:3]}
    assert pairs(all_reports["specialists"], "crop_type", "breeding_institution", "count") == want


def test_means(all_reports, pdf):
    long = pdf.explode("data_sources").dropna(subset=["data_sources", "data_completeness_score"])
    want = long.groupby("data_sources").data_completeness_score.mean()
    got = {r.source: r["mean"] for r in all_reports["completeness_by_source"].collect()}
    assert got == pytest.approx(want.to_dict())


def test_summary(all_reports, pdf):
    r = all_reports["summary"].first()
    size = pdf.stressors_tolerated.map(len)
    assert (r.total_varieties, r.unique_crops, r.unique_institutions) == (300, 4, 3)
    assert r.mean_completeness == pytest.approx(pdf.data_completeness_score.mean())
    assert (r.with_traits, r.multi_trait_count) == ((size > 0).sum(), (size >= 3).sum())
    assert r.recent_count == (pdf.year_of_release >= 2010).sum()
    assert r.good_quality_percent == pytest.approx((pdf.quality_flag.str.upper() == "GOOD").mean() * 100)
    assert r.high_confidence_percent == pytest.approx((pdf.confidence_level.str.upper() == "HIGH").mean() * 100)
    assert r.top_crop_count == pdf.crop_type.value_counts().iloc[0] and r.unique_states == 4
    assert r.top_trait_count == pdf.stressors_tolerated.explode().value_counts().iloc[0]


def test_multi_trait_and_range(all_reports, pdf):
    assert all_reports["multi_trait"].count() == (pdf.stressors_tolerated.map(len) >= 3).sum()
    assert all_reports["usual_range"].count() == ((pdf.maturity_days < 300) & (pdf.year_of_release > 1990)).sum()


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", ["x"]), (2, None, ["x"]), (3, "a", None)], "i int, s string, l array<string>")
    got = {r.column_name: (r.dtype, r.missing_values, r.unique_values, r.nested) for r in stats.column_profile(df).collect()}
    assert got == {"i": ("int", 0, 3, False), "s": ("string", 1, 1, False), "l": ("array<string>", 1, 1, True)}
    assert {r.column_name: r.unique_values for r in stats.unique_counts(df, ["i", "s"], approximate=True).collect()} == {"i": 3, "s": 1}


def test_profile_holds_a_bounded_number_of_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr(stats, "TASK_ROWS", 100)
    df = spark.range(1000).coalesce(1).selectExpr(
        "id", "if(id % 4 = 0, null, named_struct('a', id % 7, 'b', 'x')) AS s", "id % 3 AS f", "id % 2 = 0 AS g", "'one' AS o")
    profile = stats.column_profile(df)
    plan = profile._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning(10)" in plan and "sha2(" in plan
    got = {r.column_name: (r.missing_values, r.unique_values) for r in profile.collect()}
    assert got == {"id": (0, 1000), "s": (250, 7), "f": (0, 3), "g": (0, 2), "o": (0, 1)}
    monkeypatch.setattr(stats, "TASK_ROWS", 1000)
    assert "RoundRobin" not in stats.column_profile(df)._jdf.queryExecution().toString()


def test_cap_per_group(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in range(90)], "i int, g string")
    wide = spark.range(20_000).selectExpr("id % 2 AS g", "id AS i")
    some = counts.cap_per_group(wide, "g", ["i"], 5000)
    assert some.groupBy("g").agg(F.count("*").alias("n"), F.max("i").alias("m")).orderBy("g").collect() == [(0, 5000, 9998), (1, 5000, 9999)]
    capped = counts.cap_per_group(df, "g", ["i"], 5)
    assert sorted(r.i for r in capped.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 12]
    assert "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()


def test_all_reports_need_two_scans_and_two_filters(spark, catalogue, tmp_path):
    """Facts and totals scan the catalogue once each; only the two reports that list rows read it besides."""
    catalogue.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    kinds, groups = ({x for need in reports.NEEDS.values() for x in need[i]} for i in (0, 1))
    assert scans(reports.fact_counts(stored, kinds)) == scans(reports.row_totals(stored, groups)) == 1
    every = reports.profile_catalogue(stored)
    assert list(every) == list(reports.NEEDS) and len(every) == 31
    direct = [name for name, frame in every.items() if str(tmp_path) in "".join(frame.inputFiles())]
    assert direct == ["multi_trait", "usual_range"]


def test_reports_equal_the_single_operators(spark, catalogue, all_reports):
    from cropweave.operators import kpis

    single = {
        "missing": stats.missing_stats(catalogue), "describe": stats.describe(catalogue, stats.numeric_columns(catalogue)),
        "unique": stats.unique_counts(catalogue, ["variety_name", "crop_type", "breeding_institution"]),
        "year_histogram": counts.histogram(catalogue, "year_of_release", 20),
        "missing_correlations": stats.missing_correlations(catalogue, catalogue.columns),
        "states": counts.top_k(counts.element_counts(catalogue, "recommended_states", "state"), 15),
        "stressor_totals": counts.element_totals(catalogue, "stressors_tolerated"),
        "quality_trait_sizes": counts.size_histogram(catalogue, "quality_traits"),
        "decades": counts.decade_counts(catalogue, "year_of_release"),
        "institutions": counts.value_counts(catalogue, "breeding_institution"),
        "specialists": counts.specialists(catalogue, "crop_type", "breeding_institution"),
        "completeness_by_crop": counts.mean_by(catalogue, "crop_type", "data_completeness_score", "crop_type"),
        "strong_pairs": stats.strong_pairs(stats.correlations(catalogue, stats.numeric_columns(catalogue))),
        "summary": kpis.summary_kpis(catalogue)}
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    rows = lambda df: sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    for name, frame in single.items():
        assert sorted(frame.columns) == sorted(all_reports[name].columns), name
        assert rows(frame) == rows(all_reports[name]), name


def test_reports_of_an_empty_catalogue(catalogue):
    every = reports.profile_catalogue(catalogue.limit(0))
    assert every["unique"].where("unique_values = 0").count() == 3
    assert every["summary"].first().total_varieties == 0 and every["crops"].count() == 0 and every["year_histogram"].count() == 0
