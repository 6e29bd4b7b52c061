"""Word-set join against all pairs; profiles that grow; a publication that breaks off."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cropweave.operators import similar_sets, stats
from cropweave.plans import publication
from cropweave.sources import versions


def word_sets(names):
    keys = {re.sub(r"\W", " ", n).lower().strip() for n in names if n}
    return {k: frozenset(k.split()) for k in keys if k}


def brute(left, right, percent, rarity):
    a, b = word_sets(left), word_sets(right)
    sets = set(a.values()) | set(b.values())
    weight = {}
    for word in set().union(*sets):
        n = sum(word in s for s in sets)
        weight[word] = max(1, math.floor(100 * math.log1p(len(sets) / n) + 0.5)) if rarity else 1
    total = lambda s: sum(weight[w] for w in s)
    return {(x, y): (total(a[x] & b[y]), total(a[x] | b[y])) for x in a for y in b
            if a[x] & b[y] and 100 * total(a[x] & b[y]) >= percent * total(a[x] | b[y])}


@pytest.mark.parametrize("percent, rarity, cell", [(50, False, 4096), (50, True, 4096), (80, True, 3), (34, False, 2), (100, False, 4096)])
def test_similar_sets_equal_all_pairs(spark, monkeypatch, percent, rarity, cell):
    monkeypatch.setattr(similar_sets, "CELL_SETS", cell)
    rng = random.Random(percent)
    pool = ["the"] * 6 + ["seed", "of"] * 3 + [f"w{i}" for i in range(25)]
    name = lambda: rng.choice(["-", " ", "  "]).join(rng.choices(pool, k=rng.randint(1, 6)))
    left, right = [[*(name() for _ in range(80)), "The Seed", "seed THE", None, "", " - "] for _ in range(2)]
    frames = [spark.createDataFrame([(n,) for n in names], "n string") for names in (left, right)]
    found = similar_sets.similar_sets(*frames, left_name="n", right_name="n", percent=percent, rarity=rarity).collect()
    got = {(r.left_key, r.right_key): (r.shared, r.weight) for r in found}
    assert got == brute(left, right, percent, rarity) and len(found) == len(got)


def test_profiles_of_batches_add_up(spark, tmp_path):
    rows = [(i, None if i % 4 == 0 else f"v{i % 700}", [i % 5] if i % 3 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "i int, s string, l array<int>")
    for k in (0, 1, 2, 1):
        stats.add_batch(df.where(F.col("i") % 3 == k), str(tmp_path / "p"), f"b{k}")
    grown = {r.column_name: r for r in stats.grown_profile(spark.read.parquet(str(tmp_path / "p"))).collect()}
    for r in stats.column_profile(df).collect():
        got = grown[r.column_name]
        assert (got.dtype, got.missing_values, got.nested) == (r.dtype, r.missing_values, r.nested)
        assert got.missing_percent == pytest.approx(r.missing_percent) and abs(got.unique_values - r.unique_values) <= 1 + 0.033 * r.unique_values


def test_publication_that_breaks_off(spark, tmp_path, monkeypatch):
    from cropweave.workload.duplicates import enriched_parts

    records = enriched_parts(spark, "/root/testdata/sf0.001")
    root = str(tmp_path / "published")
    publication.publish(records.where("src_pos < 100"), root, "2024-01-01T00:00:00")
    before = {t: versions.read_version(spark, root, t).count() for t in ("catalogue", "details", "search_index")}

    def broken(*_):
        raise RuntimeError("ended between two writes")

    monkeypatch.setattr(publication.search, "write_index", broken)
    with pytest.raises(RuntimeError):
        publication.publish(records, root, "2024-01-02T00:00:00")
    assert {t: versions.read_version(spark, root, t).count() for t in before} == before and before["catalogue"] > 0
    assert len(versions.commits(root)) == 1
