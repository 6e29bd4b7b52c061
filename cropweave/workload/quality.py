"""Scores, rules and catalogue search over documents and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.operators import quality
from cropweave.sources.readers import read_table, spread
from cropweave.workload.registry import query

_GROUPS = {"essential": (50, ("source", "lang", "quality", "absent", "words")), "stress": (30, ("toxic", "note")),
           "quality": (20, ("n_chars",))}


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """All documents with their labels (null where unlabelled) and an array of their distinct initials."""
    note = F.when(F.col("n_chars") % 3 == 0, F.lit(" ")).when(F.col("n_chars") % 3 == 1, F.lit("Not Specified")).otherwise(F.lit("x"))
    words = F.array_distinct(F.filter(F.transform(F.split("text", " "), lambda w: F.lower(F.left(w, F.lit(1)))), lambda c: c.rlike("^[a-c]$")))
    return (spread(read_table(spark, d, "documents")).join(read_table(spark, d, "labels"), "doc_id", "left")
            .select("doc_id", "source", "lang", "quality", "toxic", "n_chars", note.alias("note"), words.alias("words")))


_LABELLED = r"""
d AS (SELECT doc_id, source, lang, quality, toxic, n_chars, CASE n_chars % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'Not Specified' ELSE 'x' END AS note,
             list_distinct(list_filter(list_transform(string_split(text, ' '), lambda w: lower(left(w, 1))), lambda c: regexp_full_match(c, '[a-c]'))) AS words
      FROM documents LEFT JOIN labels USING (doc_id)),
s AS (SELECT *, (2 + CAST(quality IS NOT NULL AS INTEGER) + CAST(len(words) > 0 AS INTEGER)) * 0.5 / 5
              + (CAST(toxic IS NOT NULL AS INTEGER) + CAST(note = 'x' AS INTEGER)) * 0.3 / 2 + 0.2 AS score FROM d)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    docs = labelled(spark, d)
    return docs.withColumn("score", quality.completeness_score(docs, _GROUPS))


@query("completeness_score", f"WITH {_LABELLED} SELECT doc_id, round(score, 6) AS score FROM s")
def completeness_score(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("doc_id", F.round("score", 6).alias("score"))


@query("confidence_level", f"""WITH {_LABELLED}
SELECT doc_id, CASE WHEN round(score, 6) >= 0.9 AND len(words) >= 2 AND coalesce(quality = 1, false) THEN 'HIGH'
                    WHEN round(score, 6) >= 0.7 AND len(words) >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
       CASE WHEN round(score, 6) >= 0.95 THEN 'EXCELLENT' WHEN round(score, 6) >= 0.8 THEN 'GOOD'
            WHEN round(score, 6) >= 0.5 THEN 'MODERATE' ELSE 'POOR' END AS flag FROM s""")
def confidence_level(spark: SparkSession, d: str) -> DataFrame:
    score = F.round("score", 6)
    return scored(spark, d).select(
        "doc_id", quality.confidence_level(score, F.size("words"), F.col("quality") == 1).alias("confidence"),
        quality.quality_flag(score, excellent=0.95).alias("flag"))


@query("composite_quality", f"""WITH {_LABELLED}
SELECT doc_id, round(score * 0.4 + coalesce(quality, 0) * 0.3 + coalesce(1 - toxic, 0) * 0.2, 6) AS composite FROM s""")
def composite_quality(spark: SparkSession, d: str) -> DataFrame:
    parts = {"completeness": "score", "source_reliability": F.col("quality").cast("double"),
             "cross_validation": (1 - F.col("toxic")).cast("double")}
    return scored(spark, d).select("doc_id", F.round(quality.composite_quality(parts), 6).alias("composite"))


@query("quality_rules", """
SELECT p_partkey, concat_ws(',', CASE WHEN 1960 + p_size NOT BETWEEN 1968 AND 2025 THEN 'year_range' END,
         CASE WHEN p_size * 10 NOT BETWEEN 60 AND 200 THEN 'maturity_range' END,
         CASE WHEN p_size % 2 = 1 THEN 'yield_units' END,
         CASE WHEN p_type = 'LARGE' THEN 'stress_categories' END,
         CASE WHEN p_type <> 'SMALL' THEN 'crop_categories' END) AS violations FROM part""")
def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    size, kind = F.col("p_size"), F.col("p_type")
    parts = read_table(spark, d, "part").select(
        "p_partkey", (size + 1960).alias("year"), (size * 10).alias("days"),
        F.when(size % 2 == 0, F.lit("Q/ha")).otherwise(F.lit("bushel")).alias("unit"),
        F.when(kind == "LARGE", F.array(F.lit("Drought"), F.lit("Hail"))).otherwise(F.array(F.lit("cold"))).alias("stresses"),
        F.when(kind == "SMALL", F.lit("PULSES")).otherwise(kind).alias("category"))
    rules = quality.standard_rules("year", "days", "unit", "stresses", "category")
    return parts.select("p_partkey", F.array_join(quality.rule_violations(rules), ",").alias("violations"))


_NAMES = {"crop": "lang", "state": "words", "stressors": "words", "institution": "source", "score": "score", "flag": "flag"}


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).withColumn("score", F.round("score", 6)).withColumn("flag", quality.quality_flag("score"))


@query("search_by_group", f"""WITH {_LABELLED}
SELECT doc_id, lang FROM s WHERE lang = 'en' AND list_contains(words, 'a') AND round(score, 6) >= 0.8""")
def search_by_group(spark: SparkSession, d: str) -> DataFrame:
    found = quality.search_catalogue(_flagged(spark, d), crop="en", state="a", flags=["good"], columns=_NAMES)
    return found.select("doc_id", "lang")


@query("search_by_trait", f"""WITH {_LABELLED}
SELECT doc_id, source FROM s WHERE source = 'src3' AND list_has_any(words, ['b', 'c']) AND round(score, 6) >= 0.6""")
def search_by_trait(spark: SparkSession, d: str) -> DataFrame:
    found = quality.search_catalogue(_flagged(spark, d), institution="src3", stressors=["b", "c"], min_score=0.6, columns=_NAMES)
    return found.select("doc_id", "source")
