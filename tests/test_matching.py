import random
import re

import pytest
from pyspark.sql import functions as F

from cropweave.operators import matching
from cropweave.plans import registries
from test_similarity import plain_score


def norm(name):
    return re.sub(r"\W", " ", name).lower().strip()


def brute_force(left, right, threshold):
    want = {}
    for i, name, crop in left:
        pool = [r for r in right if r[2] == crop] or right
        scored = [(plain_score(norm(name), norm(r[1])), -r[0]) for r in pool]
        score, position = max(scored)
        want[i] = (score, -position) if score >= threshold else (0, None)
    return want


def mutate(rng, name):
    letters = list(name)
    for _ in range(rng.randint(0, 4)):
        i = rng.randrange(len(letters) + 1)
        kind = rng.random()
        if kind < 0.4:
            letters.insert(i, rng.choice("abcde12"))
        elif letters and kind < 0.7:
            letters.pop(min(i, len(letters) - 1))
        elif letters:
            letters[min(i, len(letters) - 1)] = rng.choice("abcde12")
    return "".join(letters).strip() or "b"


@pytest.mark.parametrize("threshold, cell_keys", [(80, 4096), (80, 5), (91, 4096), (60, 5)])
def test_best_match_equals_brute_force(spark, monkeypatch, threshold, cell_keys):
    """Blocks, null blocks, a block only on the left, equal names, long names, and one crop holding most rows.

    With few keys per cell every common signature is split.
    """
    monkeypatch.setattr(matching, "CELL_KEYS", cell_keys)
    rng = random.Random(threshold)
    crops = ["x"] * 6 + ["y", None]
    word = lambda: "".join(rng.choice("abcde 12") for _ in range(rng.choice([1, 2, 5, 9, 14, 30, 130]))).strip() or "a"
    right = [(i, word(), rng.choice(crops)) for i in range(140)]
    right += [(200 + i, right[i][1], right[i][2]) for i in range(20)]
    left = [(i, mutate(rng, rng.choice(right)[1]) if rng.random() < 0.7 else word(), rng.choice([*crops, "z"])) for i in range(140)]
    out = matching.best_matches(
        spark.createDataFrame(left, "id int, n string, c string"), spark.createDataFrame(right, "rid int, rn string, rc string").repartition(5),
        left_name="n", left_block="c", right_name="rn", right_block="rc", right_order=["rid"], threshold=threshold)
    got = {r.id: (r.score, r.match.rid if r.match else None) for r in out.collect()}
    want = brute_force(left, right, threshold)
    assert got == want
    assert any(v[1] is not None for v in want.values()) and any(v[1] is None for v in want.values())


@pytest.mark.parametrize("threshold, variants", [(60, 1), (80, 1_024), (80, 60), (95, 1_024), (100, 30)])
def test_rounds_and_variants_find_the_same(spark, monkeypatch, threshold, variants):
    """Every way to look for a pair: short pairs of any length, one round and several."""
    monkeypatch.setattr(matching, "KEYS_A_VARIANT", 1)
    monkeypatch.setattr(matching, "VARIANTS", variants)
    rng = random.Random(threshold + variants)
    word = lambda: "".join(rng.choice("abc d1") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 12, 25]))).strip() or "a"
    right = [(i, word(), "x") for i in range(90)]
    left = [(i, mutate(rng, rng.choice(right)[1]), "x") for i in range(90)]
    frames = (spark.createDataFrame(left, "id int, n string, c string"), spark.createDataFrame(right, "rid int, rn string, rc string"))
    want = brute_force(left, right, threshold)
    for least in (0, 1_000):
        monkeypatch.setattr(matching, "ROUND_KEYS", least)
        out = matching.best_matches(*frames, left_name="n", left_block="c", right_name="rn", right_block="rc", right_order=["rid"], threshold=threshold)
        assert {r.id: (r.score, r.match.rid if r.match else None) for r in out.collect()} == want


def test_pairs_that_meet_are_few(spark):
    """Names of few syllables: the pairs that meet grow far less than the square of the names."""
    rng = random.Random(2)
    syllables = ["the", "an", "er", "in", "re", "on", "st", "nd", "ha", "es", "ou", "ed"]
    names = sorted({"".join(rng.choice(syllables) for _ in range(rng.randint(2, 5))) for _ in range(3_000)})
    keys = spark.createDataFrame([("block", "x", n) for n in names], "scope string, block string, key string")
    assert matching.joined_pairs(keys, keys.where("true"), 90).count() < 0.02 * len(names) ** 2


def test_registry_edge_rows(spark):
    left = spark.createDataFrame(
        [(1, " PR-124 ", "Rice"), (2, "Pusa Basmati", "RICE"), (3, None, "Wheat"), (4, "", "Wheat"), (5, "HD 3226", "Millet"),
         (6, "XQ", "Rice"), (7, "PR 124", "Rice"), (8, "Bhima", None)], "src_pos long, variety_name string, crop string")
    right = spark.createDataFrame(
        [(1, "pr124", "rice"), (2, "PR 124", "rice"), (3, "PR-124", "rice"), (4, "pusa basmati", "rice"), (5, "hd 3226", "wheat"),
         (6, "Bhima", None), (7, "Bhima", "rice")], "src_pos long, name string, crop string")
    rows = {r.csc_raw_id: r for r in registries.match_registries(left, right, "2024-01-01 00:00:00").collect()}
    assert sorted(rows) == [f"CSC_{i:06d}" for i in (1, 2, 5, 6, 7, 8)]
    assert (rows["CSC_000001"].similarity_score, rows["CSC_000001"].seednet_variety_original) == (100, "PR 124")
    assert rows["CSC_000007"].seednet_variety_original == "PR 124"
    assert rows["CSC_000005"].seednet_crop_clean == "wheat" and rows["CSC_000005"].match_status == "MATCHED"
    assert rows["CSC_000006"].match_status == "UNMATCHED" and rows["CSC_000006"].review_priority == "HIGH"
    assert rows["CSC_000008"].seednet_crop_original is None and rows["CSC_000008"].similarity_score == 100
    assert len(rows["CSC_000001"].asDict()) == 17


def test_missing_name_column_is_reported(spark):
    df = spark.createDataFrame([(1, "a")], "src_pos long, title string")
    with pytest.raises(ValueError, match="variety"):
        registries.prepare_right(df)


def test_hot_name_costs_one_comparison(spark):
    """A third of both sides is one name; every left row still gets its result."""
    left = [(i, "hot name" if i % 3 == 0 else f"variety {i} {i * 7919 % 1000}", "x") for i in range(600)]
    right = [(i, "hot nama" if i % 3 == 0 else f"variety {i} {i * 7919 % 1000}", "x") for i in range(600)]
    out = matching.best_matches(
        spark.createDataFrame(left, "id int, n string, c string"), spark.createDataFrame(right, "rid int, rn string, rc string"),
        left_name="n", left_block="c", right_name="rn", right_block="rc", right_order=["rid"])
    rows = out.collect()
    assert len(rows) == 600
    assert {(r.score, r.match.rid) for r in rows if r.n == "hot name"} == {(88, 0)}
    assert all(r.score == 100 and r.match.rid == r.id for r in rows if r.n != "hot name")


def test_report_and_sample(spark, tmp_path):
    left = spark.createDataFrame([(i, f"name {i} of {1990 + i}", "c") for i in range(20)], "src_pos long, variety_name string, crop string")
    right = spark.createDataFrame([(i, f"name {i} of {1990 + i}", "c") for i in range(0, 20, 2)], "src_pos long, name string, crop string")
    final = registries.run(left, right, str(tmp_path), "2024-01-01 00:00:00", threshold=100, sample=4)
    assert final.where("csc_year between 1990 and 2009").count() == 20
    report = spark.read.json(f"{tmp_path}/reports").first()
    assert (report.total_csc_varieties, report.matched_varieties, report.match_rate) == (20, 10, 50.0)
    for status in ("matched", "unmatched"):
        assert spark.read.option("header", True).csv(f"{tmp_path}/manual_review/{status}_sample").count() == 4
    assert spark.read.parquet(f"{tmp_path}/raw_data/left").count() == 20
    again = matching.review_sample(final.repartition(7), "csc_raw_id", n=4)
    first = matching.review_sample(final, "csc_raw_id", n=4)
    assert {r.csc_raw_id for r in again.collect()} == {r.csc_raw_id for r in first.collect()}


def test_empty_report_has_no_rate(spark):
    empty = spark.createDataFrame([], "match_status string, match_confidence string, review_priority string")
    assert matching.match_report(empty).first().match_rate is None


def test_no_nested_loop_join(spark):
    left = spark.createDataFrame([(1, "abcdef", "x")], "id int, n string, c string")
    out = matching.similar_pairs(left.select(F.lit("block").alias("scope"), F.col("c").alias("block"), F.col("n").alias("key")),
                                 left.select(F.lit("block").alias("scope"), F.col("c").alias("block"), F.col("n").alias("key")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_bad_year_cells_are_null(spark):
    from cropweave.plans.registries import prepare_left

    cells = ["NaN", "1e12", "text", " 2015 ", None, "2016.0"]
    df = spark.createDataFrame([(i, f"name {i}", "rice", c) for i, c in enumerate(cells)],
                               "src_pos long, variety_name string, crop string, extracted_year string")
    rows = prepare_left(df).orderBy("csc_raw_id").collect()
    assert [r.year_extracted for r in rows] == [None, None, None, 2015, None, 2016]


def test_institutions_of_matches(spark):
    from cropweave.plans.registries import match_registries

    left = spark.createDataFrame([(1, "PR-124", "Rice", "PAU, Ludhiana"), (2, "Zx9", "Rice", "PAU")],
                                 "src_pos long, variety_name string, crop string, institution string")
    right = spark.createDataFrame([(1, "PR 124", "Rice", "pau ludhiana")],
                                  "src_pos long, variety_name string, crop_name string, breeding_institution string")
    rows = match_registries(left, right, "2024-01-01 00:00:00").orderBy("csc_raw_id").collect()
    assert [(r.match_status, r.institution_agrees) for r in rows] == [("MATCHED", True), ("UNMATCHED", None)]


def test_frequent_signatures_are_counted_by_buckets_first(spark, monkeypatch):
    rows = [("block", "x", s, k) for s in range(300) for k in (1, -1) for _ in range(s % 7)]
    rows += [("all", None, 5, 1)] * 9 + [("block", None, 5, 1)] * 9
    df = spark.createDataFrame(rows, "scope string, block string, signature long, kept int")
    group = ("scope", "block", "signature", "kept")
    want = sorted(map(str, df.groupBy(*group).count().where("count > 5").collect()))
    assert len(want) > 80
    for buckets in (1, 64, 1 << 18):
        monkeypatch.setattr(matching, "COUNT_BUCKETS", buckets)
        found = matching._frequent(df, group, 5)
        assert sorted(map(str, found.withColumnRenamed("n", "count").collect())) == want
    # whatever is grouped by signature has passed the filter by buckets
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.count("_bucket") > 3


def test_few_left_keys_do_not_multiply_a_crowded_right_side(spark, monkeypatch):
    """A right key is written once for each part of the left side, and every pair still meets in one cell."""
    monkeypatch.setattr(matching, "CELL_KEYS", 5)
    group = ("scope", "block", "signature", "kept")
    side = lambda key, n: spark.createDataFrame(
        [("block", block, 7, -1, f"{key}{i}") for block in ("x", None) for i in range(n)], f"scope string, block string, signature long, kept int, {key}_key string")
    for lefts, rights in ((2, 100), (12, 100), (100, 3)):
        a, b = side("left", lefts), side("right", rights)
        crowded = matching._crowded(a, b, group)
        left = matching._celled(a, crowded, group, "left_key", "left_split", "right_split")
        right = matching._celled(b, crowded, group, "right_key", "right_split", "left_split")
        assert right.count() == 2 * rights * (lefts // 5 + 1) and left.count() == 2 * lefts * (rights // 5 + 1)
        met = left.alias("a").join(right.alias("b"), matching._same(*group, "left_split", "right_split"))
        assert met.count() == met.select("a.block", "left_key", "right_key").distinct().count() == 2 * lefts * rights


def test_right_signatures_without_a_partner_are_not_stored(spark, monkeypatch):
    left = [(i, f"ab{'cd' * i}e", "x") for i in range(1, 4)]
    right = [(i, "".join(chr(ord("k") + int(d)) for d in str(i * 7919)), "x") for i in range(400)] + [(900, "abcdcde", "x")]
    stored = []
    stage = matching.stage_table
    monkeypatch.setattr(matching, "stage_table", lambda df: stored.append(stage(df)) or stored[-1])
    keys = [spark.createDataFrame([("block", c, n) for _, n, c in rows], "scope string, block string, key string")
            for rows in (left, right)]
    assert {(r.left_key, r.right_key) for r in matching.similar_pairs(*keys, 80).collect()} >= {("abcdcde", "abcdcde")}
    signed = [df.count() for df in stored if "right_key" in df.columns]
    assert signed and sum(signed) < 100  # 400 keys have several signatures each
