"""Counts, summaries, correlations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.operators import counts, kpis, stats
from cropweave.plans import reports
from cropweave.session import stage_table
from cropweave.sources.readers import read_table, spread
from cropweave.workload.registry import query


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


_WORDS = r"[\p{L}\p{N}]+"
_WORDS_SQL = r"SELECT doc_id, lang, source, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS words FROM documents"


def worded(spark: SparkSession, d: str) -> DataFrame:
    """All documents with the array of their distinct words."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_WORDS), F.lit(0)))
    return spread(read_table(spark, d, "documents")).select("doc_id", "lang", "source", words.alias("words"))


def dated_orders(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))


def parts_of_lines(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    return read_table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))


@query("value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return counts.value_counts(orders, "o_orderpriority")


@query("top_k", "SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, l_partkey LIMIT 15")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return counts.top_k(counts.value_counts(read_table(spark, d, "lineitem"), "l_partkey"), 15)


@query("first_rows", "SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def first_rows(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").orderBy("ts", "event_id").limit(5).select("event_id", "event_type")


@query("unique_counts", """
SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS unique_values FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders""")
def unique_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.unique_counts(read_table(spark, d, "orders"), ["o_custkey", "o_orderstatus", "o_orderdate"])


_DESCRIBE = """SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {t}"""


@query("describe", " UNION ALL ".join(_DESCRIBE.format(c=c, t="lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")))
def describe(spark: SparkSession, d: str) -> DataFrame:
    """Quartiles come from order statistics spread over several buckets."""
    summary = stats.describe(read_table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return _rounded(summary, "mean", "std", "q25", "q50", "q75")


def _holey(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_totalprice") > 250_000, F.col("o_totalprice")).alias("o_totalprice"))


_HOLEY = """h AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
  CASE WHEN o_totalprice > 250000 THEN o_totalprice END AS o_totalprice FROM orders)"""


@query("missing_stats", f"WITH {_HOLEY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, round(100.0 * (count(*) - count({c})) / count(*), 2) AS missing_percentage FROM h"
    for c in ("o_orderstatus", "o_orderpriority", "o_totalprice")))
def missing_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.missing_stats(_holey(spark, d))


@query("column_profile", f"WITH {_HOLEY}, x AS (SELECT *, ['a', o_orderstatus] AS pair FROM h) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) - count({c}) AS missing_values, round(100.0 * (count(*) - count({c})) / count(*), 6) "
    f"AS missing_percent, count(DISTINCT {c}) AS unique_values, {n} AS nested FROM x"
    for c, t, n in (("o_orderkey", "bigint", "false"), ("o_orderstatus", "string", "false"), ("o_orderpriority", "string", "false"),
                    ("o_totalprice", "double", "false"), ("pair", "array<string>", "true"))))
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    frame = _holey(spark, d).withColumn("pair", F.array(F.lit("a"), F.col("o_orderstatus")))
    return _rounded(stats.column_profile(frame), "missing_percent")


@query("histogram", """
WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(least(19, floor((l_extendedprice - lo) / (hi - lo) * 20)) AS INTEGER) AS bin, count(*) AS count FROM lineitem, e GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * (hi - lo) / 20, 6) AS bin_start, round(lo + (i + 1) * (hi - lo) / 20, 6) AS bin_end,
       coalesce(b.count, 0) AS count FROM range(20) t(i), e LEFT JOIN b ON b.bin = i""")
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(counts.histogram(read_table(spark, d, "lineitem"), "l_extendedprice", 20), "bin_start", "bin_end")


@query("size_histogram", f"WITH w AS ({_WORDS_SQL}) SELECT len(words) AS size, count(*) AS count FROM w GROUP BY 1")
def size_histogram(spark: SparkSession, d: str) -> DataFrame:
    return counts.size_histogram(worded(spark, d), "words")


@query("element_counts", f"WITH w AS ({_WORDS_SQL}) SELECT word, count(*) AS count FROM (SELECT unnest(words) AS word FROM w) GROUP BY 1")
def element_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts.element_counts(worded(spark, d), "words", "word")


@query("element_totals", f"""WITH w AS ({_WORDS_SQL})
SELECT count_if(len(words) > 0) AS rows_with_values, count_if(len(words) = 0) AS rows_without_values,
       CAST(sum(len(words)) AS BIGINT) AS total_values, count_if(len(words) >= 3) AS rows_with_many FROM w""")
def element_totals(spark: SparkSession, d: str) -> DataFrame:
    return counts.element_totals(worded(spark, d), "words")


@query("crosstab", f"""WITH w AS ({_WORDS_SQL})
SELECT word, lang, count(*) AS count FROM (SELECT unnest(words) AS word, lang FROM w) GROUP BY ALL""")
def crosstab(spark: SparkSession, d: str) -> DataFrame:
    return counts.cross_counts(counts.elements(worded(spark, d), "words", "word", "lang"), "word", "lang")


@query("crosstab_wide", f"""WITH w AS ({_WORDS_SQL})
SELECT word, count_if(lang = 'en') AS en, count_if(lang = 'fr') AS fr, count_if(lang = 'es') AS es, count_if(lang = 'de') AS de
FROM (SELECT unnest(words) AS word, lang FROM w) GROUP BY word""")
def crosstab_wide(spark: SparkSession, d: str) -> DataFrame:
    return counts.cross_table(crosstab(spark, d), "word", "lang", ["en", "fr", "es", "de"])


@query("crosstab_top", """
WITH c AS (SELECT p_brand, l_suppkey, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
r AS (SELECT l_suppkey FROM c GROUP BY 1 ORDER BY sum(count) DESC, l_suppkey LIMIT 10),
k AS (SELECT p_brand FROM c GROUP BY 1 ORDER BY sum(count) DESC, p_brand LIMIT 8)
SELECT r.l_suppkey, k.p_brand, coalesce(c.count, 0) AS count FROM r CROSS JOIN k LEFT JOIN c ON c.l_suppkey = r.l_suppkey AND c.p_brand = k.p_brand""")
def crosstab_top(spark: SparkSession, d: str) -> DataFrame:
    cells = counts.cross_counts(parts_of_lines(spark, d), "l_suppkey", "p_brand")
    return counts.top_cross_counts(cells, "l_suppkey", "p_brand")


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "amount")
_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i:]]
_AMOUNTS = "x AS (SELECT *, CASE WHEN l_tax > 0 THEN l_quantity * 100 + l_extendedprice / 1000 END AS amount FROM lineitem)"


def _amounts(spark: SparkSession, d: str) -> DataFrame:
    amount = F.when(F.col("l_tax") > 0, F.col("l_quantity") * 100 + F.col("l_extendedprice") / 1000)
    return spread(read_table(spark, d, "lineitem")).withColumn("amount", amount)


@query("correlations", f"WITH {_AMOUNTS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM x" for a, b in _PAIRS))
def correlations(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(stats.correlations(_amounts(spark, d), _NUMBERS), "correlation")


@query("strong_pairs", f"WITH {_AMOUNTS} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM x" for a, b in _PAIRS if a != b)
    + ") WHERE abs(correlation) > 0.5")
def strong_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(stats.strong_pairs(stats.correlations(_amounts(spark, d), _NUMBERS)), "correlation")


_HOLES = ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


@query("missing_correlations", f"WITH {_HOLEY} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
    f"CASE WHEN '{a}' = 'o_orderkey' OR '{b}' = 'o_orderkey' THEN NULL ELSE round(corr(CAST({a} IS NULL AS INTEGER), CAST({b} IS NULL AS INTEGER)), 6) END AS correlation FROM h"
    for i, a in enumerate(_HOLES) for b in _HOLES[i:]))
def missing_correlations(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(stats.missing_correlations(_holey(spark, d), _HOLES), "correlation")


@query("year_counts", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS count FROM orders GROUP BY 1")
def year_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts.value_counts(dated_orders(spark, d), "year")


@query("decade_counts", "SELECT CAST(year(o_orderdate) // 10 * 10 AS VARCHAR) || 's' AS decade, count(*) AS count FROM orders GROUP BY 1")
def decade_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts.decade_counts(dated_orders(spark, d), "year")


@query("recent_by_group", """
SELECT o_orderpriority, count(*) AS count FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY 1 ORDER BY count DESC, o_orderpriority LIMIT 10""")
def recent_by_group(spark: SparkSession, d: str) -> DataFrame:
    return counts.top_k(counts.recent_counts(dated_orders(spark, d), "o_orderpriority", "year", since=1998), 10)


@query("diversity", """
SELECT l_suppkey, count(DISTINCT p_brand || p_type) AS count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def diversity(spark: SparkSession, d: str) -> DataFrame:
    kinds = parts_of_lines(spark, d).withColumn("kind", F.concat("p_brand", "p_type"))
    return counts.diversity(kinds, "l_suppkey", "kind")


@query("specialists", """
WITH c AS (SELECT p_brand, l_suppkey, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
g AS (SELECT p_brand FROM c GROUP BY 1 ORDER BY sum(count) DESC, p_brand LIMIT 5)
SELECT p_brand, l_suppkey, count, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY count DESC, l_suppkey) AS INTEGER) AS rank
FROM c WHERE p_brand IN (SELECT p_brand FROM g) QUALIFY rank <= 3""")
def specialists(spark: SparkSession, d: str) -> DataFrame:
    return counts.specialists(parts_of_lines(spark, d), "p_brand", "l_suppkey")


@query("mean_by_source", """
WITH s AS (SELECT unnest([source, lang]) AS source, CAST(quality AS DOUBLE) AS quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT source, round(avg(quality), 6) AS mean FROM s WHERE quality IS NOT NULL GROUP BY 1""")
def mean_by_source(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").join(read_table(spark, d, "labels"), "doc_id", "left")
    sources = docs.select(F.explode(F.array("source", "lang")).alias("source"), "quality")
    return _rounded(counts.mean_by(sources, "source", "quality", "source"), "mean")


@query("mean_by_group", "SELECT p_type, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY 1")
def mean_by_group(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(counts.mean_by(read_table(spark, d, "part"), "p_type", "p_retailprice", "p_type"), "mean")


@query("multi_trait", f"WITH w AS ({_WORDS_SQL}) SELECT doc_id AS variety_name, lang AS crop_type, list_reduce(list_sort(words), lambda a, b: a || ', ' || b) AS traits FROM w WHERE len(words) >= 3")
def multi_trait(spark: SparkSession, d: str) -> DataFrame:
    return reports.multi_trait(worded(spark, d).select(
        F.col("doc_id").alias("variety_name"), F.col("lang").alias("crop_type"),
        F.array_sort("words").alias("stressors_tolerated")))


@query("usual_range", "SELECT p_partkey, CAST(floor(p_retailprice / 5) AS INTEGER) AS maturity_days, 1960 + p_size AS year_of_release FROM part "
                      "WHERE CAST(floor(p_retailprice / 5) AS INTEGER) < 300 AND 1960 + p_size > 1990")
def usual_range(spark: SparkSession, d: str) -> DataFrame:
    """Outlier filter; nulls drop out."""
    return reports.usual_range(read_table(spark, d, "part").select(
        "p_partkey", F.floor(F.col("p_retailprice") / 5).cast("int").alias("maturity_days"),
        (1960 + F.col("p_size")).alias("year_of_release")))


@query("missing_report", """
WITH w AS (SELECT doc_id, nullif(source, 'src0') AS source, nullif(lang, 'en') AS lang, CASE WHEN n_chars > 500 THEN n_chars END AS n_chars FROM documents),
m AS (SELECT count(*) AS n, count(*) - count(source) AS s, count(*) - count(lang) AS l, count(*) - count(n_chars) AS c FROM w)
SELECT 'source' AS column_name, s AS missing_count, round(100.0 * s / n, 6) AS missing_percentage FROM m WHERE s > 0
UNION ALL SELECT 'lang', l, round(100.0 * l / n, 6) FROM m WHERE l > 0
UNION ALL SELECT 'n_chars', c, round(100.0 * c / n, 6) FROM m WHERE c > 0""")
def missing_report(spark: SparkSession, d: str) -> DataFrame:
    holes = read_table(spark, d, "documents").select(
        "doc_id", F.nullif("source", F.lit("src0")).alias("source"), F.nullif("lang", F.lit("en")).alias("lang"),
        F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("n_chars"))
    return _rounded(stats.missing_stats(holes).orderBy(F.desc("missing_count"), "column_name"), "missing_percentage")


_KPI_COLUMNS = {"crop": "lang", "institution": "source", "score": "score", "traits": "traits", "year": "year", "states": "states",
                "quality": "flag", "confidence": "level"}


def catalogue_documents(spark: SparkSession, d: str) -> DataFrame:
    """All documents with catalogue-like columns derived from their labels and words."""
    docs = worded(spark, d).join(read_table(spark, d, "labels"), "doc_id", "left")
    letters = F.filter("words", lambda w: F.length(w) == 2)
    return docs.select("doc_id", "lang", "source", F.col("quality").cast("double").alias("score"),
                       letters.alias("traits"), F.filter("words", lambda w: F.length(w) == 1).alias("states"),
                       (F.lit(1985) + F.col("doc_id") % 40).cast("int").alias("year"),
                       F.when(F.col("quality") == 1, F.lit("Good")).when(F.col("quality") == 0, F.lit("POOR")).alias("flag"),
                       F.when(F.col("toxic") == 0, F.lit("High")).otherwise(F.lit("Low")).alias("level"))


@query("summary_kpis", f"""WITH w AS ({_WORDS_SQL}),
c AS (SELECT w.doc_id, lang, source, CAST(quality AS DOUBLE) AS score, list_filter(words, lambda x: length(x) = 2) AS traits,
             list_filter(words, lambda x: length(x) = 1) AS states, CAST(1985 + doc_id % 40 AS INTEGER) AS year,
             CASE quality WHEN 1 THEN 'Good' WHEN 0 THEN 'POOR' END AS flag, CASE WHEN toxic = 0 THEN 'High' ELSE 'Low' END AS level
      FROM w LEFT JOIN labels USING (doc_id)),
b AS (SELECT count(*) AS total_varieties, count(DISTINCT lang) AS unique_crops, count(DISTINCT source) AS unique_institutions,
             round(avg(score), 6) AS mean_completeness, round(count(DISTINCT lang) / count(*), 6) AS crop_diversity_index,
             count_if(len(traits) > 0) AS with_traits, round(100.0 * count_if(len(traits) > 0) / count(*), 6) AS with_traits_percent,
             count_if(len(traits) >= 3) AS multi_trait_count, count_if(year >= 2010) AS recent_count,
             round(avg(CASE WHEN year >= 1990 THEN year END), 6) AS mean_year_since_1990,
             round(100.0 * count_if(upper(flag) = 'GOOD') / count(*), 6) AS good_quality_percent,
             round(100.0 * count_if(upper(level) = 'HIGH') / count(*), 6) AS high_confidence_percent,
             count_if(score < 0.5) AS low_completeness_count FROM c),
t1 AS (SELECT lang, count(*) AS n FROM c GROUP BY 1 ORDER BY n DESC, lang LIMIT 1),
t2 AS (SELECT source, count(*) AS n FROM c GROUP BY 1 ORDER BY n DESC, source LIMIT 1),
t3 AS (SELECT source, count(DISTINCT lang) AS n FROM c GROUP BY 1 ORDER BY n DESC, source LIMIT 1),
t4 AS (SELECT x, count(*) AS n FROM (SELECT unnest(traits) AS x FROM c) GROUP BY 1 ORDER BY n DESC, x LIMIT 1),
s AS (SELECT x, count(*) AS n FROM (SELECT unnest(states) AS x FROM c) GROUP BY 1), t5 AS (SELECT * FROM s ORDER BY n DESC, x LIMIT 1)
SELECT b.*, t1.lang AS top_crop, t1.n AS top_crop_count, t2.source AS top_institution, t2.n AS top_institution_count,
       t3.source AS top_diverse_institution, t3.n AS top_diverse_institution_count, t4.x AS top_trait, t4.n AS top_trait_count,
       t5.x AS top_state, t5.n AS top_state_count, (SELECT count(*) FROM s) AS unique_states FROM b, t1, t2, t3, t4, t5""")
def summary_kpis(spark: SparkSession, d: str) -> DataFrame:
    kpi = kpis.summary_kpis(stage_table(catalogue_documents(spark, d)), _KPI_COLUMNS)
    return _rounded(kpi, "mean_completeness", "crop_diversity_index", "with_traits_percent", "mean_year_since_1990",
                    "good_quality_percent", "high_confidence_percent")
