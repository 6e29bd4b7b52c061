import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropweave.operators import ordering


@pytest.fixture(scope="module")
def shuffled(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50):02d}", i) for i in range(2000)]
    return spark.createDataFrame(rows, "name string, pos long").repartition(7)


def test_positions_are_gap_free(shuffled):
    got = ordering.with_position(shuffled, ["name", "pos"]).collect()
    want = sorted((r.name, r.pos) for r in got)
    assert [(r.name, r.pos) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(2000))


def test_order_of_input_does_not_matter(shuffled):
    a = ordering.with_sequential_id(shuffled, ["pos"], "id", "CSC_")
    b = ordering.with_sequential_id(shuffled.repartition(3), ["pos"], "id", "CSC_")
    assert {(r.pos, r.id) for r in a.collect()} == {(r.pos, r.id) for r in b.collect()}
    assert a.where("pos = 0").first().id == "CSC_000001"


def test_weighted_positions(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(500)], "v int, w int")
    got = ordering.with_position(df, ["v"], "before", weight="w").orderBy("v").collect()
    total = 0
    for r in got:
        assert r.before == total
        total += r.w


def test_ids_are_checked(spark):
    good = spark.createDataFrame([("a",), ("b",)], "id string")
    ordering.require_unique(good, "id")
    with pytest.raises(ValueError, match="2 unique ids in 3 rows"):
        ordering.require_unique(good.union(good.limit(1)), "id")
    with pytest.raises(ValueError):
        ordering.require_unique(good.union(spark.createDataFrame([(None,)], "id string")), "id")


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    values = [float(x) for x in np.round(rng.normal(50, 20, 3001), 1)] + [50.0] * 1500
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    got = {r.probability: r.value for r in ordering.exact_quantiles(df, "v", (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p))
    assert len(got) == 5


def test_quantiles_of_nothing(spark):
    assert ordering.exact_quantiles(spark.createDataFrame([], "v double"), "v", (0.5,)).count() == 0


def test_quantiles_of_several_columns(spark):
    rows = [("a", float(i)) for i in range(11)] + [("b", 5.0)] * 3 + [("b", 7.0), ("c", None)]
    got = ordering.exact_quantiles_by(spark.createDataFrame(rows, "g string, v double"), "g", "v", (0.5, 1.0)).collect()
    assert sorted((r.g, r.probability, r.value) for r in got) == [("a", 0.5, 5.0), ("a", 1.0, 10.0), ("b", 0.5, 5.0), ("b", 1.0, 7.0)]


def test_positions_of_nothing(spark):
    assert ordering.with_position(spark.range(0), ["id"]).collect() == []
