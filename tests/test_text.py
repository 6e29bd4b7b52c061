import random
import re
import string

import pytest
from pyspark.sql import functions as F

from cropweave.functions import labels, text


def one(spark, column, *values):
    """Results of a column expression over literal rows of a string column ``x``."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.r for r in df.select("i", column.alias("r")).orderBy("i").collect()]


def test_clean_key(spark):
    assert one(spark, text.clean_key("x"), " PR-124\t", " Rice \n", "  ", "", None) == ["pr-124", "rice", None, None, None]


def test_compare_key_keeps_unicode_words_and_underscores(spark):
    assert one(spark, text.compare_key("x"), "PR-124", "Été_x!", "--") == ["pr 124", "été_x", ""]


def test_title_case_matches_python(spark):
    rng = random.Random(5)
    names = ["dbgs-54a pusa's", "DPWO-1", "HD 3226", "él ñu-4b"]
    names += ["".join(rng.choice(string.ascii_letters + "-' 123éñ") for _ in range(12)) for _ in range(200)]
    assert one(spark, text.title_case("x"), *names) == [n.title() for n in names]


@pytest.mark.parametrize("value, year", [
    ("released 2015-03-26", 2015), ("GO 120151", None), ("1968 and 2010", 1968), ("x", None), ("in 1868", None)])
def test_year_in_text(spark, value, year):
    assert one(spark, text.year_in_text("x"), value) == [year]


def test_first_year_goes_left_to_right(spark):
    df = spark.createDataFrame([("none", "2001", "1999")], "a string, b string, c string")
    assert df.select(text.first_year(["a", "b", "c"])).first()[0] == 2001


def test_to_number(spark):
    assert one(spark, text.to_number("x"), "12", " 3.5 ", "x", None) == [12.0, 3.5, None, None]


def test_name_features(spark):
    got = one(spark, text.name_features("x"), "Bitter Gourd C.v. DBGS-54", "HD 3226", "DPWO-1", "123", None)
    u = "Unknown"
    assert [tuple(r) for r in got] == [
        ("Bitter Gourd C", "DBGS", "54", "C.v."), ("HD", u, "3226", u), ("DPWO", "DPWO", "1", u), (u, u, "123", u), (u, u, u, u)]


def test_split_values_drops_short_ones(spark):
    assert one(spark, text.split_values("x"), "PR-124, PR-126;IR 64\nX1", "") == [["PR-124", "PR-126", "IR 64"], []]


def test_year_cell(spark):
    assert [tuple(r) for r in one(spark, text.year_cell("x"), "2015\n(3)", "2016", "")] == [("2015", "3"), ("2016", ""), ("", "")]


def test_date_in_text(spark):
    got = one(spark, text.date_in_text("x", F.lit("2024-01-01")), "Meeting 2015_3-6", "2015-12-31!", "none")
    assert got == ["2015-03-06", "2015-12-31", "2024-01-01"]


def test_slug_matches_python(spark):
    def expected(t):
        s = re.sub(r"[-\s]+", "-", re.sub(r"[^\w\s-]", "", t)).strip("-")
        return s[:50] if s else "Document"
    values = ["Été -- of (the) PDF ", "!!", "a" * 80, "- x -", "under_score"]
    assert one(spark, text.slug("x"), *values) == [expected(v) for v in values]


def test_document_key(spark):
    df = spark.createDataFrame([("92nd/CSC", "a.pdf"), ("Unknown", "my file.v2.pdf"), (None, ".pdf"), ("", "b.pdf")], "n string, f string")
    got = [r[0] for r in df.select(text.document_key("n", "f", F.lit("20240101"))).collect()]
    assert got == ["AgriRegulatory_92ndCSC_20240101_ExtractedData", "AgriRegulatory_myfilev2_20240101_ExtractedData",
                   "AgriRegulatory_pdf_20240101_ExtractedData", "AgriRegulatory_b_20240101_ExtractedData"]


def test_truncate_decade_percent(spark):
    assert one(spark, text.truncate_label("x", 3), "abc", "abcd") == ["abc", "abc..."]
    assert spark.range(1).select(text.decade(F.lit(2019)), text.percent(F.lit(1), F.lit(3)), text.percent(F.lit(1), F.lit(0))).first()[:] == ("2010s", 33.33, None)


def test_match_labels(spark):
    rows = [(100, "MATCHED"), (95, "MATCHED"), (94, "MATCHED"), (90, "MATCHED"), (89, "MATCHED"), (60, "MATCHED"), (59, "MATCHED"), (0, "UNMATCHED")]
    df = spark.createDataFrame(rows, "s int, m string")
    got = [tuple(r) for r in df.select(labels.match_confidence("s"), labels.review_priority("m", "s"), labels.needs_review("m", "s")).collect()]
    assert got == [("HIGH", "LOW", False), ("HIGH", "LOW", False), ("MEDIUM", "LOW", True), ("MEDIUM", "LOW", True),
                   ("MEDIUM", "MEDIUM", True), ("LOW", "MEDIUM", True), ("VERY_LOW", "MEDIUM", True), ("VERY_LOW", "HIGH", True)]


def test_crop_group_defaults(spark):
    assert one(spark, labels.crop_group("x"), "garlic", "Bottle Gourd", "Tea", None) == ["BULB VEGETABLES", "CUCURBITS", "CEREALS", "CEREALS"]


def test_derived_classes(spark):
    df = spark.createDataFrame([(90, True, "x", "ICAR Delhi"), (120, False, "Pure line selection", "PAU"), (130, None, None, None)],
                               "d int, h boolean, m string, i string")
    got = [tuple(r) for r in df.select(labels.maturity_group("d"), labels.variety_type("h", "m"),
                                       labels.keyword_class("i", [("ICAR", "ICAR"), ("pau", "SAU")], "Private")).collect()]
    assert got == [("Early", "Hybrid", "ICAR"), ("Medium", "Selection", "SAU"), ("Late", "Improved", "Private")]
    assert one(spark, labels.standard_state("x", {"orissa": "odisha"}), " Orissa ", "Punjab") == ["odisha", "punjab"]
