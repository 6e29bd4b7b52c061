"""Duplicate classification, consolidation and publication over parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.operators import duplicates
from cropweave.operators.columns import project_paths
from cropweave.operators.ordering import with_sequential_id
from cropweave.plans import publication
from cropweave.sources.readers import read_table
from cropweave.workload.registry import query

_CLASSIFIED = """
r AS (SELECT p_partkey, p_name || ' ' || p_brand AS k, p_type AS prefix, CAST(p_size % 2 AS VARCHAR) AS num FROM part),
v AS (SELECT k, prefix, num, count(*) AS n, min(p_partkey) AS first FROM r GROUP BY ALL),
g AS (SELECT k, sum(n) AS size, min(n) AS fewest, count(DISTINCT prefix) AS np, count(DISTINCT num) AS nn, min(first) AS first
      FROM v GROUP BY k HAVING sum(n) > 1),
c AS (SELECT k, first, CASE WHEN fewest >= 2 THEN 'Exact Match' WHEN np = 1 AND nn > 1 THEN 'Related but Distinct'
                     ELSE 'Typo/Formatting Issue' END AS category, row_number() OVER (ORDER BY k) - 1 AS match_id FROM g),
a AS (SELECT r.p_partkey, r.k, coalesce(c.category, 'Unique') AS category, coalesce(c.match_id, -1) AS match_id,
             coalesce(c.first, r.p_partkey) AS first FROM r LEFT JOIN c ON r.k = c.k)"""


def _analyzed(spark: SparkSession, d: str) -> DataFrame:
    parts = read_table(spark, d, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("k"), F.col("p_type").alias("prefix"),
        (F.col("p_size") % 2).cast("string").alias("num"))
    return duplicates.analyze_duplicates(parts, "k", "prefix", "num", "p_partkey")


@query("dup_classify", f"WITH {_CLASSIFIED} SELECT p_partkey, category, match_id FROM a")
def dup_classify(spark: SparkSession, d: str) -> DataFrame:
    return _analyzed(spark, d).select(
        "p_partkey", F.col("duplicate_category").alias("category"), F.col("duplicate_match_id").alias("match_id"))


@query("dup_totals", f'WITH {_CLASSIFIED} SELECT category, count(*) AS "rows" FROM a GROUP BY 1')
def dup_totals(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.duplicate_totals(_analyzed(spark, d))


@query("dup_consolidate", f"""WITH {_CLASSIFIED}
SELECT p_partkey, k, category FROM a WHERE category IN ('Unique', 'Related but Distinct') OR p_partkey = first""")
def dup_consolidate(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.consolidate(_analyzed(spark, d), "p_partkey").select(
        "p_partkey", "k", F.col("duplicate_category").alias("category"))


@query("publish_columns", """
SELECT 'STS_' || lpad(CAST(row_number() OVER (ORDER BY c_custkey) AS VARCHAR), 6, '0') AS variety_id, c_name AS variety_name,
       coalesce(n_name, 'Unknown') AS crop_type, 'Unknown' AS approval_status FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def publish_columns(spark: SparkSession, d: str) -> DataFrame:
    nation = read_table(spark, d, "nation")
    nested = read_table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.col("n_name").alias("nation")).alias("original_data"))
    flat = project_paths(nested, {"variety_name": "original_data.name", "crop_type": "original_data.nation",
                                  "approval_status": "original_data.approval"}, keep=["c_custkey"])
    return with_sequential_id(flat, ["c_custkey"], "variety_id", "STS_").drop("c_custkey")


def enriched_parts(spark: SparkSession, d: str) -> DataFrame:
    """Nested enriched records derived from every part."""
    level = lambda c: F.struct(c.alias("tolerance_level"), F.array("p_brand", "p_type").alias("evidence_sources"))
    size = F.col("p_size")
    graded = F.when(size > 35, F.lit("high")).when(size > 15, F.lit("medium"))
    kinds = {k: level(graded if i % 2 else F.lower("p_type")) for i, k in enumerate(publication.STRESS_TYPES)}
    name = F.concat_ws("-", F.upper("p_brand"), size.cast("string"))
    return read_table(spark, d, "part").select(
        F.col("p_partkey").alias("src_pos"),
        F.struct(name.alias("variety_name"), F.lower("p_type").alias("crop_type"),
                 F.when(size % 3 == 0, F.lit("Released")).alias("approval_status"),
                 F.concat_ws(" ", "p_name", "p_brand").alias("variety_standardized")).alias("original_data"),
        F.struct(F.struct(name.alias("variety_name")).alias("variety_analysis"),
                 F.struct(*[v.alias(k) for k, v in kinds.items()]).alias("stress_tolerance_profile"),
                 F.struct(F.col("p_retailprice").alias("reliability_score")).alias("evidence_quality_assessment"))
        .alias("analysis_result"))


_PUBLISHED = [n for n, _, _ in publication.PUBLISHED]
_FIXED = {"variety_name": "name", "crop_type": "crop", "approval_status": "approval",
          "stress_tolerance_drought": "lower(p_type)", "stress_tolerance_heat": "graded", "stress_tolerance_salinity": "lower(p_type)",
          "stress_tolerance_flood": "graded", "stress_tolerance_disease": "graded", "stress_tolerance_pest": "lower(p_type)",
          "evidence_quality_score": "p_retailprice"}
_ENRICHED = """
s AS (SELECT *, p_name || ' ' || p_brand AS k, upper(p_brand) || '-' || p_size AS raw,
             'Brand#' || substr(p_brand, 7) || '-' || p_size AS name, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS crop,
             CASE WHEN p_size % 3 = 0 THEN 'Released' ELSE 'Unknown' END AS approval,
             CASE WHEN p_size > 35 THEN 'high' WHEN p_size > 15 THEN 'medium' END AS graded FROM part),
f AS (SELECT *, coalesce(nullif(regexp_extract(raw, '([A-Z]+)-', 1), ''), 'Unknown') AS prefix,
             coalesce(nullif(regexp_extract(raw, '(\\d+)', 1), ''), 'Unknown') AS num FROM s),
v AS (SELECT k, prefix, num, count(*) AS n, min(p_partkey) AS first FROM f GROUP BY ALL),
g AS (SELECT k, min(n) AS fewest, count(DISTINCT prefix) AS np, count(DISTINCT num) AS nn, min(first) AS first
      FROM v GROUP BY k HAVING sum(n) > 1),
kept AS (SELECT f.* FROM f LEFT JOIN g ON f.k = g.k
         WHERE g.k IS NULL OR (g.fewest < 2 AND g.np = 1 AND g.nn > 1) OR f.p_partkey = g.first)"""


@query("catalogue", f"""WITH {_ENRICHED}
SELECT 'STS_' || lpad(CAST(row_number() OVER (ORDER BY p_partkey) AS VARCHAR), 6, '0') AS variety_id,
""" + ",\n".join(f"{_FIXED.get(n, repr('Unknown'))} AS {n}" for n in _PUBLISHED) + "\nFROM kept")
def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Classify, consolidate and publish: all 22 columns."""
    return publication.build_catalogue(enriched_parts(spark, d))[0]


@query("catalogue_summary", f"""WITH {_ENRICHED},
e AS (SELECT p_partkey, CASE WHEN g.k IS NULL THEN 'Unique' WHEN g.fewest >= 2 THEN 'Exact Match' WHEN np = 1 AND nn > 1 THEN 'Related but Distinct'
             ELSE 'Typo/Formatting Issue' END AS category FROM f LEFT JOIN g ON f.k = g.k)
SELECT (SELECT count(*) FROM f) AS initial_row_count, (SELECT count(*) FROM kept) AS final_row_count,
       (SELECT count(DISTINCT p_brand) FROM part) AS input_files, '1.0' AS processing_version, '2024-01-01T00:00:00' AS timestamp,
       (SELECT string_agg(category || ':' || n, ',' ORDER BY category) FROM (SELECT category, count(*) AS n FROM e GROUP BY 1)) AS duplicate_analysis""")
def catalogue_summary(spark: SparkSession, d: str) -> DataFrame:
    enriched = enriched_parts(spark, d)
    files = read_table(spark, d, "part").select(F.concat(F.lit("batch/"), "p_brand", F.lit(".json")).alias("source_path"))
    published, totals = publication.build_catalogue(enriched)
    summary = publication.synthesis_summary(files, enriched, published, totals, "2024-01-01T00:00:00")
    categories = F.array_sort(F.transform(F.map_entries("duplicate_analysis"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))))
    return summary.withColumn("duplicate_analysis", F.array_join(categories, ","))


@query("child_table", """
WITH s AS (SELECT *, CASE WHEN p_size > 35 THEN 'high' WHEN p_size > 15 THEN 'medium' END AS graded FROM part),
k AS (SELECT unnest(['drought_tolerance', 'heat_tolerance', 'salinity_tolerance', 'flood_tolerance', 'submergence_tolerance',
             'disease_resistance', 'pest_resistance']) AS stress_type, unnest([0, 1, 0, 1, 0, 1, 0]) AS g)
SELECT p_partkey AS variety_id, stress_type, CASE WHEN g = 1 THEN graded ELSE lower(p_type) END AS tolerance_level,
       p_brand || '; ' || p_type AS evidence_source, p_retailprice AS confidence_score
FROM s, k WHERE CASE WHEN g = 1 THEN graded ELSE lower(p_type) END IS NOT NULL""")
def child_table(spark: SparkSession, d: str) -> DataFrame:
    return publication.tolerance_details(enriched_parts(spark, d), "src_pos",
                                         confidence="analysis_result.evidence_quality_assessment.reliability_score")


@query("json_export", """
WITH s AS (SELECT *, CASE WHEN p_size > 35 THEN 'high' WHEN p_size > 15 THEN 'medium' END AS graded FROM part),
e AS (SELECT *, lambda_free FROM (SELECT *, '; ' AS lambda_free FROM s)),
t AS (SELECT p_partkey, '{"level":"' || lower(p_type) || '","evidence":"' || p_brand || '; ' || p_type || '"}' AS a,
             '{"level":"' || graded || '","evidence":"' || p_brand || '; ' || p_type || '"}' AS b, p_name, p_brand, p_type FROM s)
SELECT p_partkey AS variety_id, '{"variety_id":' || p_partkey || ',"variety_name":"' || p_name || '","traits":["' || p_brand || '","' || p_type
  || '"],"stress_tolerance_details":{' || CASE WHEN b IS NULL THEN '' ELSE '"disease_resistance":' || b || ',' END
  || '"drought_tolerance":' || a || CASE WHEN b IS NULL THEN '' ELSE ',"flood_tolerance":' || b || ',"heat_tolerance":' || b END
  || ',"pest_resistance":' || a || ',"salinity_tolerance":' || a || ',"submergence_tolerance":' || a || '}}' AS document FROM t""")
def json_export(spark: SparkSession, d: str) -> DataFrame:
    parents = read_table(spark, d, "part").select(
        F.col("p_partkey").alias("variety_id"), F.col("p_name").alias("variety_name"), F.array("p_brand", "p_type").alias("traits"))
    details = publication.tolerance_details(enriched_parts(spark, d), "src_pos")
    return publication.nested_json(parents, details)


@query("foreign_keys", """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')""")
def foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose order is not among the open ones: the orphan check of a child table."""
    from cropweave.operators.quality import orphans

    child = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_suppkey")
    parent = read_table(spark, d, "orders").where(F.col("o_orderstatus") != "F")
    return orphans(child, parent, "o_orderkey").withColumnRenamed("o_orderkey", "l_orderkey")
