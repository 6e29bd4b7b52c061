"""Registry matching over terms: page titles against document or benchmark vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.functions import similarity
from cropweave.functions.text import compare_key
from cropweave.operators import matching, quality
from cropweave.plans.registries import match_registries
from cropweave.session import stage_table
from cropweave.sources.readers import read_table, spread
from cropweave.workload.registry import query

RUN_TS = "2024-01-01 00:00:00"
_WORDS = r"[\p{L}\p{N}]+"


def _vocabulary(df: DataFrame, text: str, block: str, position: str, stride: int) -> DataFrame:
    """Distinct (block, term) with the position of the first occurrence as ``src_pos``, stored as a registry table."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORDS), F.lit(0))
    rows = spread(df).select(F.col(block).alias("crop"), F.col(position).alias("_p"), F.posexplode(words).alias("_w", "variety_name"))
    first = F.min(F.col("_p") * stride + F.col("_w")).alias("src_pos")
    return stage_table(rows.groupBy("crop", "variety_name").agg(first))


def title_terms(spark: SparkSession, d: str) -> DataFrame:
    """Left registry: terms of page titles, by page language, with untidy cells."""
    pages = read_table(spark, d, "pages").select(
        "page_id", F.upper(F.regexp_extract("html", r'<html lang="(\w+)"', 1)).alias("lang"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"))
    terms = _vocabulary(pages, "title", "lang", "page_id", 1_000)
    return terms.select("src_pos", F.concat(F.lit("  "), "variety_name", F.lit(" ")).alias("variety_name"), "crop")


def document_terms(spark: SparkSession, d: str) -> DataFrame:
    """Right registry: terms of all document texts, by language."""
    return _vocabulary(read_table(spark, d, "documents"), "text", "lang", "doc_id", 1_000_000)


def benchmark_terms(spark: SparkSession, d: str) -> DataFrame:
    """Right registry of one block only: terms of the English passages."""
    passages = read_table(spark, d, "benchmark").withColumn("lang", F.lit("en"))
    return _vocabulary(passages, "text", "lang", "item_id", 1_000_000)


_LEFT_SQL = r"""
pg AS (SELECT page_id, lower(regexp_extract(html, '<html lang="(\w+)"', 1)) AS lang,
              regexp_extract_all(lower(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)), '[\p{L}\p{N}]+') AS w FROM pages),
lt AS (SELECT lang, term, min(page_id * 1000 + pos) AS src_pos
       FROM (SELECT page_id, lang, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM pg) GROUP BY ALL),
l AS (SELECT *, 'CSC_' || lpad(CAST(row_number() OVER (ORDER BY src_pos) AS VARCHAR), 6, '0') AS id FROM lt)"""
_RIGHT_SQL = r"""
rw AS (SELECT {block} AS lang, {pos} AS p, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM {table}),
r AS (SELECT lang, term, min(p * 1000000 + pos) AS src_pos
      FROM (SELECT lang, p, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM rw) GROUP BY ALL)"""
_LCS = """list_reduce(string_split(a, ''), lambda rw, ca: list_reduce(range(1, length(b) + 1), lambda acc, j:
    list_append(acc, CASE WHEN substr(b, j, 1) = ca THEN rw[j] + 1 ELSE greatest(rw[j + 1], acc[-1]) END), [0]),
    [0 for x in range(0, length(b) + 1)])[-1]"""
# levenshtein counts bytes here; an edit of a letter changes at most four.
_BEST_SQL = f"""
k AS (SELECT l.*, CASE WHEN l.lang IN (SELECT lang FROM r) THEN l.lang END AS scope FROM l),
same AS (SELECT k.id, r.lang, r.term, r.src_pos, 100 AS score FROM k JOIN r
         ON k.term = r.term AND (k.scope = r.lang OR k.scope IS NULL)),
near AS (SELECT k.id, k.term AS a, r.term AS b, r.lang, r.src_pos,
                length(k.term) + length(r.term) AS s FROM k JOIN r ON (k.scope = r.lang OR k.scope IS NULL)
         AND least(length(k.term), length(r.term)) >= 0.3975 * (length(k.term) + length(r.term)) - 1e-9
         AND levenshtein(k.term, r.term) <= 0.205 * (length(k.term) + length(r.term))
             * CASE WHEN strlen(k.term) = length(k.term) AND strlen(r.term) = length(r.term) THEN 1 ELSE 4 END + 1e-9
         WHERE k.id NOT IN (SELECT id FROM same)),
uniq AS (SELECT a, b, CAST(round_even(200.0 * {_LCS} / (length(a) + length(b)), 0) AS INTEGER) AS score
         FROM (SELECT DISTINCT a, b FROM near)),
scored AS (SELECT id, lang, b AS term, src_pos, score FROM near JOIN uniq USING (a, b) WHERE score >= 80
           UNION ALL SELECT id, lang, term, src_pos, score FROM same),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, src_pos) = 1),
m AS (SELECT l.id AS csc_raw_id, '  ' || l.term || ' ' AS csc_variety_original, l.term AS csc_variety_clean,
             upper(l.lang) AS csc_crop_original, l.lang AS csc_crop_clean, CAST(NULL AS INTEGER) AS csc_year,
             CASE WHEN b.id IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS match_status,
             coalesce(b.score, 0) AS similarity_score,
             b.term AS seednet_variety_original, b.term AS seednet_variety_clean,
             b.lang AS seednet_crop_original, b.lang AS seednet_crop_clean
      FROM l LEFT JOIN best b ON l.id = b.id),
final AS (SELECT *, CASE WHEN similarity_score >= 95 THEN 'HIGH' WHEN similarity_score >= 80 THEN 'MEDIUM'
                         WHEN similarity_score >= 60 THEN 'LOW' ELSE 'VERY_LOW' END AS match_confidence,
                 similarity_score < 95 AS manual_review_needed,
                 CASE WHEN match_status = 'UNMATCHED' THEN 'HIGH' WHEN similarity_score < 90 THEN 'MEDIUM' ELSE 'LOW' END
                   AS review_priority, 'CSC' AS data_source FROM m)"""


def _sql(table: str, block: str, pos: str, tail: str) -> str:
    right = _RIGHT_SQL.format(table=table, block=block, pos=pos)
    return f"WITH {_LEFT_SQL}, {right}, {_BEST_SQL} {tail}"


_DOCUMENTS = ("documents", "lang", "doc_id")
_BENCHMARK = ("benchmark", "'en'", "item_id")


@query("fuzzy_match", _sql(*_DOCUMENTS, "SELECT * FROM final"))
def fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    return match_registries(title_terms(spark, d), document_terms(spark, d), RUN_TS).drop("processing_timestamp")


@query("fuzzy_match_fallback", _sql(*_BENCHMARK, "SELECT * FROM final"))
def fuzzy_match_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Only English has right rows, so all other languages are compared with every term."""
    return match_registries(title_terms(spark, d), benchmark_terms(spark, d), RUN_TS).drop("processing_timestamp")


@query("match_report", _sql(*_BENCHMARK, """
SELECT count(*) AS total_csc_varieties, count_if(match_status = 'MATCHED') AS matched_varieties,
       count_if(match_status = 'UNMATCHED') AS unmatched_varieties,
       count_if(match_confidence = 'HIGH') AS confidence_high, count_if(match_confidence = 'MEDIUM') AS confidence_medium,
       count_if(match_confidence = 'LOW') AS confidence_low, count_if(match_confidence = 'VERY_LOW') AS confidence_very_low,
       count_if(review_priority = 'HIGH') AS priority_high, count_if(review_priority = 'MEDIUM') AS priority_medium,
       count_if(review_priority = 'LOW') AS priority_low,
       round(100.0 * count_if(match_status = 'MATCHED') / count(*), 6) AS match_rate FROM final"""))
def match_report(spark: SparkSession, d: str) -> DataFrame:
    report = matching.match_report(fuzzy_match_fallback(spark, d))
    return report.withColumn("match_rate", F.round("match_rate", 6))


@query("review_sample", """
WITH s AS (SELECT o_orderkey, o_orderstatus, md5('7|' || CAST(o_orderkey AS VARCHAR)) AS draw FROM orders)
SELECT o_orderkey, o_orderstatus FROM s
QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY draw, o_orderkey) <= 100""")
def review_sample(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return matching.review_sample(orders, "o_orderkey", status="o_orderstatus", n=100, seed="7")


@query("name_similarity", rf"""
WITH p AS (SELECT DISTINCT lower(trim(regexp_replace(p_name, '\W', ' ', 'g'))) AS a,
                  lower(trim(regexp_replace(p_brand || ' ' || p_name, '\W', ' ', 'g'))) AS b FROM part)
SELECT a, b, levenshtein(a, b) AS edit_distance, CAST(round_even(200.0 * {_LCS} / (length(a) + length(b)), 0) AS INTEGER) AS ratio,
       round(jaro_winkler_similarity(a, b), 6) AS jaro_winkler,
       round(len(list_intersect(string_split(a, ' '), string_split(b, ' ')))
             / CAST(len(list_distinct(string_split(a, ' ') || string_split(b, ' '))) AS DOUBLE), 6) AS token_jaccard,
       round(list_sum([CAST(len(list_filter(string_split(a, ' '), lambda x: x = w)) * len(list_filter(string_split(b, ' '), lambda x: x = w)) AS DOUBLE)
                       for w in list_distinct(string_split(a, ' '))])
             / sqrt(list_sum([CAST(len(list_filter(string_split(a, ' '), lambda x: x = w)) ** 2 AS DOUBLE) for w in list_distinct(string_split(a, ' '))]))
             / sqrt(list_sum([CAST(len(list_filter(string_split(b, ' '), lambda x: x = w)) ** 2 AS DOUBLE) for w in list_distinct(string_split(b, ' '))])), 6)
         AS token_cosine
FROM p""")
def name_similarity(spark: SparkSession, d: str) -> DataFrame:
    pairs = read_table(spark, d, "part").select(
        compare_key("p_name").alias("a"), compare_key(F.concat_ws(" ", "p_brand", "p_name")).alias("b")).distinct()
    ta, tb = similarity.tokens("a"), similarity.tokens("b")
    return pairs.select("a", "b", F.levenshtein("a", "b").alias("edit_distance"),
                        similarity.indel_score("a", "b").alias("ratio"),
                        F.round(similarity.jaro_winkler("a", "b"), 6).alias("jaro_winkler"),
                        F.round(similarity.token_jaccard(ta, tb), 6).alias("token_jaccard"),
                        F.round(similarity.token_cosine(ta, tb), 6).alias("token_cosine"))


@query("institution_agreement", r"""
WITH p AS (SELECT l_orderkey, l_linenumber, lower(p_type) AS a, lower(trim(regexp_replace(p_name || ' ' || p_type, '\W', ' ', 'g'))) AS b
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, a = b OR coalesce(len(list_intersect(string_split(a, ' '), string_split(b, ' ')))
       / CAST(len(list_distinct(string_split(a, ' ') || string_split(b, ' '))) AS DOUBLE) >= 0.5, false) AS agrees FROM p""")
def institution_agreement(spark: SparkSession, d: str) -> DataFrame:
    parts = read_table(spark, d, "part").select(
        "p_partkey", similarity.tokens_agree("p_type", F.concat_ws(" ", "p_name", "p_type")).alias("agrees"))
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "agrees")


@query("consistency_check", """
WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS status, CAST(NULL AS BIGINT) AS lines FROM orders),
b AS (SELECT l_orderkey AS k, max(l_linestatus) AS status, CAST(NULL AS BIGINT) AS lines FROM lineitem GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' ELSE 'both' END AS presence,
       a.status IS NOT DISTINCT FROM b.status AS status_agrees FROM a FULL JOIN b ON a.k = b.k""")
def consistency_check(spark: SparkSession, d: str) -> DataFrame:
    a = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    b = read_table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("status"))
    return quality.consistency_check(a, b, "k", ["status"])
