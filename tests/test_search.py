"""The inverted table of a catalogue finds what a scan finds, and reads less; versions appear whole or not at all."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cropweave.operators import quality, search
from cropweave.sources import versions

STATES, TRAITS, CROPS = ["Punjab", "Goa", "Bihar", None], ["Drought", "Heat", "Rust"], ["RICE", "WHEAT", None]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = [(i, rng.choice(CROPS), rng.choice(["IARI", "AAU", None]), rng.choice([None, round(rng.random(), 2)]),
             rng.choice(["Good", "POOR", None]), rng.choice([None, rng.choices(STATES, k=rng.randint(0, 4))]),
             rng.choice([None, rng.sample(TRAITS, rng.randint(0, 3))])) for i in range(600)]
    catalogue = spark.createDataFrame(rows, "id long, crop_type string, breeding_institution string, data_completeness_score double, "
                                            "quality_flag string, recommended_states array<string>, stressors_tolerated array<string>")
    path = str(tmp_path_factory.mktemp("index"))
    search.write_index(catalogue, path, "id")
    return catalogue, path


@pytest.mark.parametrize("given", [
    dict(zip(("crop", "state", "stressors", "institution", "min_score", "flags"), values))
    for values in itertools.product([None, "RICE"], [None, "Goa", "nowhere"], [(), ["Heat"], ["Heat", "Rust", "none"]], [None, "AAU"], [None, 0.5], [(), ["good"]])
    if values[0] or values[1] or values[2] or values[3]][::5])
def test_index_equals_scan(spark, indexed, given):
    catalogue, path = indexed
    want = sorted(r.id for r in quality.search_catalogue(catalogue, **given).collect())
    assert sorted(r.id for r in search.search_index(spark, path, **given).collect()) == want


def test_search_needs_a_term(spark, indexed):
    with pytest.raises(ValueError):
        search.search_index(spark, indexed[1], min_score=0.5)


def files_read(df):
    return {p.rsplit("/", 2)[1] + "/" + p.rsplit("/", 1)[1] for p in df.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}


def test_search_opens_only_the_shelves_of_its_terms(spark, indexed):
    found = search.search_index(spark, indexed[1], state="Goa", crop="RICE")
    plan = found._jdf.queryExecution().executedPlan().toString()
    shelf = search.shelf_of(spark, "state", "Goa")
    assert "PartitionFilters: [" in plan and f"= {shelf})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split("/")[0] for f in files_read(found)} == {f"shelf={shelf}"}
    every = spark.read.parquet(indexed[1]).inputFiles()
    chosen = [f for f in every if "kind=state" in f and f"shelf={shelf}/" in f]
    size = lambda files: sum(spark.read.format("binaryFile").load(files).select("length").toPandas()["length"])
    assert 0 < 4 * size(chosen) < size(every)


def test_a_run_that_breaks_off_is_never_seen(spark, tmp_path):
    root = str(tmp_path / "published")

    def tables(n, broken=False):
        def write(folder):
            spark.range(n).write.parquet(f"{folder}/catalogue")
            if broken:
                raise RuntimeError("ended between two writes")
            spark.range(n).selectExpr("id", "id % 3 AS part").write.parquet(f"{folder}/details")
        return write

    with pytest.raises(ValueError, match="no version"):
        versions.read_version(spark, root, "catalogue")
    with pytest.raises(RuntimeError):
        versions.publish(root, "2024-01-01", tables(1, broken=True))
    assert versions.commits(root) == []
    first = versions.publish(root, "2024-01-02", tables(3))
    assert first["number"] == 1 and first["tables"] == ["catalogue", "details"]
    with pytest.raises(RuntimeError):
        versions.publish(root, "2024-01-03", tables(7, broken=True))
    counts = lambda **when: [versions.read_version(spark, root, t, **when).count() for t in ("catalogue", "details")]
    assert counts() == [3, 3]
    versions.publish(root, "2024-01-04", tables(5))
    assert counts() == [5, 5] and counts(as_of="2024-01-03") == [3, 3] and counts(number=1) == [3, 3]
    with pytest.raises(ValueError):
        counts(as_of="2023-12-31")


def test_sources_are_reconciled_by_key(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k int, a string, b int")
    found = quality.reconcile({
        "x": frame([(1, "p", 1), (2, None, 2), (None, "n", 0), (None, "m", 0), (5, "v", 5)]),
        "y": frame([(1, "p", 9), (2, None, 2), (3, "q", 3), (None, "n", 0), (5, "v", 5), (5, "u", 5)]),
        "z": frame([(1, "r", 8), (2, "s", 2), (3, "q", 3)])}, "k", ["a", "b"])
    rows = {(r.k, tuple(r.found_in)): (tuple(r.missing_in), tuple(r.repeated_in), r.a_differs_in, r.b_differs_in, r.a_agrees, r.b_agrees)
            for r in found.collect()}
    assert rows == {
        (1, ("x", "y", "z")): ((), (), "z", "y", False, False), (2, ("x", "y", "z")): ((), (), "z", None, False, True),
        (3, ("y", "z")): (("x",), (), None, None, True, True), (5, ("x", "y")): (("z",), ("y",), "y", None, False, True),
        (None, ("x",)): (("y", "z"), ("x",), None, None, True, True), (None, ("y",)): (("x", "z"), (), None, None, True, True)}


def test_null_keys_stand_on_their_own_side(spark):
    one = spark.createDataFrame([(1, "p"), (None, "p")], "k int, a string")
    rows = quality.consistency_check(one, one, "k", ["a"]).collect()
    assert sorted((r.k or 0, r.presence, r.a_agrees) for r in rows) == [(0, "left_only", False), (0, "right_only", False), (1, "both", True)]
