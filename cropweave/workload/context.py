"""Search queries, context documents and enrichment over parts and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.operators import context as ctx
from cropweave.plans import enrichment
from cropweave.sources.readers import read_table
from cropweave.workload.registry import query

RUN_TS = "2024-01-01T00:00:00"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = "(VALUES " + ", ".join(
    f"({i}, {_quoted(kind)}, {_quoted(priority)}, {_quoted(text)})"
    for i, (kind, priority, text) in enumerate(ctx.QUERY_TEMPLATES)) + ") q(query_pos, type, priority, template)"


@query("search_queries", f"""
SELECT p_partkey, query_pos, type, replace(replace(template, '{{v}}', p_name || ' ' || p_brand), '{{c}}', p_type) AS query,
       true AS post_2008, priority FROM part, {_TEMPLATES}""")
def search_queries(spark: SparkSession, d: str) -> DataFrame:
    parts = read_table(spark, d, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("variety_name"), F.col("p_type").alias("crop_name"))
    return ctx.search_queries(parts).drop("variety_name", "crop_name")


def users(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("variety_name"), F.lit("rice").alias("crop_name")).distinct()


def event_results(spark: SparkSession, d: str) -> DataFrame:
    """Search results out of all events: purchases are publications, views, clicks and sign-ups are web pages of one
    query each, errors are failed queries."""
    name = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    kind = F.col("event_type")
    web = lambda words: F.concat(F.lit('"'), name, F.lit(f'" rice {words} after:2008'))
    query_text = (F.when(kind == "purchase", name).when(kind == "view", web("drought tolerance"))
                  .when(kind == "click", web("heat tolerance")).when(kind == "signup", web("cold tolerance"))
                  .otherwise(web("pest resistance")))
    ok = kind != "error"
    year = (F.from_json("props", "k int")["k"] + 1950).cast("string")
    return read_table(spark, d, "events").select(
        name.alias("variety_name"), query_text.alias("query"),
        F.when(kind == "purchase", F.lit("google_scholar")).otherwise(F.lit("google_search")).alias("type"),
        F.col("event_id").alias("result_pos"), ok.alias("success"), F.when(~ok, F.lit("timeout")).alias("error"),
        F.when(ok, F.concat(F.lit("t"), F.col("event_id").cast("string"))).alias("title"), year.alias("year"))


def _contexts(spark: SparkSession, d: str) -> DataFrame:
    return enrichment.compile_context(users(spark, d), event_results(spark, d), RUN_TS, fields=("title", "year"))


_CONTEXT_SQL = f"""
u AS (SELECT DISTINCT 'user' || user_id AS v FROM events),
q AS (SELECT v, query_pos, type, replace(replace(template, '{{v}}', v), '{{c}}', 'rice') AS query FROM u, {_TEMPLATES}),
e AS (SELECT 'user' || user_id AS v, event_id, event_type, CAST(1950 + CAST(props ->> 'k' AS INTEGER) AS VARCHAR) AS year,
             CASE event_type WHEN 'purchase' THEN 'user' || user_id
               ELSE '"user' || user_id || '" rice ' || CASE event_type WHEN 'view' THEN 'drought tolerance' WHEN 'click' THEN 'heat tolerance'
                    WHEN 'signup' THEN 'cold tolerance' ELSE 'pest resistance' END || ' after:2008' END AS query FROM events),
o AS (SELECT v, query, bool_or(event_type <> 'error') AS success FROM e GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY v, query ORDER BY event_id) AS rank FROM e WHERE event_type <> 'error'),
kept AS (SELECT * FROM ranked WHERE rank <= CASE WHEN event_type = 'purchase' THEN 5 ELSE 10 END
         AND (event_type <> 'purchase' OR CAST(year AS INTEGER) >= 2008)),
n AS (SELECT v, query, count(*) AS n, string_agg('t' || event_id || ':' || year, ' ' ORDER BY rank) AS titles FROM kept GROUP BY ALL),
full_q AS (SELECT q.*, coalesce(o.success, false) AS success, coalesce(n.n, 0) AS n, coalesce(n.titles, '') AS titles,
                  CASE WHEN o.success IS NULL THEN 'not executed' WHEN NOT o.success THEN 'timeout' END AS error
           FROM q LEFT JOIN o ON q.v = o.v AND q.query = o.query LEFT JOIN n ON q.v = n.v AND q.query = n.query)"""


@query("context_documents", f"WITH {_CONTEXT_SQL} SELECT v AS variety_name, query_pos, type, query, n AS count, success, error, titles FROM full_q")
def context_documents(spark: SparkSession, d: str) -> DataFrame:
    """The nested entries of all context documents, read back as rows."""
    rows = _contexts(spark, d).select("variety_info.variety_name", F.posexplode("search_results").alias("query_pos", "e"))
    titles = F.array_join(F.transform(F.coalesce("e.results", F.array().cast("array<struct<rank:int,title:string,year:string>>")),
                                      lambda r: F.concat_ws(":", r["title"], r["year"])), " ")
    return rows.select("variety_name", "query_pos", "e.type", "e.query", F.col("e.count").alias("count"), "e.success", "e.error",
                       titles.alias("titles"))


@query("context_metadata", f"""WITH {_CONTEXT_SQL}
SELECT v AS variety_name, count(*) AS total_queries, count_if(success) AS successful_queries, count_if(NOT success) AS failed_queries,
       CAST(sum(n) AS INTEGER) AS total_results FROM full_q GROUP BY v""")
def context_metadata(spark: SparkSession, d: str) -> DataFrame:
    return _contexts(spark, d).select("variety_info.variety_name", "search_metadata.*").drop("processing_timestamp")


@query("context_split", f"""WITH {_CONTEXT_SQL}
SELECT v AS variety_name, count_if(type = 'google_scholar') AS scholar, count_if(type = 'google_search') AS web FROM full_q GROUP BY v""")
def context_split(spark: SparkSession, d: str) -> DataFrame:
    split = ctx.split_by_type(_contexts(spark, d))
    return split.select("variety_info.variety_name", F.size("google_scholar_results").alias("scholar"),
                        F.size("google_search_results").alias("web"))


@query("run_counters", """
WITH q AS (SELECT user_id, event_type, min(event_id) AS e, bool_and(event_type <> 'error') AS ok, count(*) AS n FROM events GROUP BY ALL)
SELECT count(DISTINCT user_id) AS varieties_processed, count(DISTINCT CASE WHEN ok THEN user_id END) AS successful_enrichments,
       count(DISTINCT user_id) - count(DISTINCT CASE WHEN ok THEN user_id END) AS failed_enrichments,
       count(*) AS total_search_queries, count_if(ok) AS successful_queries, count_if(NOT ok) AS failed_queries,
       count_if(event_type = 'purchase') AS google_scholar_queries, count_if(event_type <> 'purchase') AS google_search_queries,
       CAST(sum(n) AS BIGINT) AS total_results FROM q""")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    queries = read_table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("count"))
    kind = F.when(F.col("event_type") == "purchase", F.lit("google_scholar")).otherwise(F.lit("google_search"))
    shaped = queries.withColumn("type", kind).withColumn("success", F.col("event_type") != "error")
    return ctx.run_counters(shaped, ["user_id"])


@query("recent_results", """
WITH r AS (SELECT event_id, event_type, 1950 + CAST(props ->> 'k' AS INTEGER) AS year,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rank FROM events)
SELECT event_id, rank FROM r WHERE rank <= CASE WHEN event_type = 'purchase' THEN 5 ELSE 10 END AND (event_type <> 'purchase' OR year >= 2008)""")
def recent_results(spark: SparkSession, d: str) -> DataFrame:
    """First results per query, then the year filter: the order matters."""
    kind = F.when(F.col("event_type") == "purchase", F.lit("google_scholar")).otherwise(F.lit("google_search"))
    hits = read_table(spark, d, "events").withColumn("type", kind).withColumn(
        "year", (F.from_json("props", "k int")["k"] + 1950).cast("string"))
    kept = ctx.keep_recent(ctx.ranked_results(hits, ["user_id", "event_type"], ["ts", "event_id"]))
    return kept.select("event_id", "rank")


def _named_customers(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "customer").select("c_custkey", F.upper("c_name").alias("variety_name"))


def _order_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Contexts named like customers in another case; many per name."""
    name = F.format_string("customer#%09d", F.col("o_custkey"))
    return read_table(spark, d, "orders").select(name.alias("name"), "o_orderkey", "o_totalprice")


@query("context_join", """
SELECT c_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def context_join(spark: SparkSession, d: str) -> DataFrame:
    joined = ctx.attach_context(_named_customers(spark, d), _order_contexts(spark, d), "variety_name", "name", ["o_orderkey"])
    return joined.select("c_custkey", "context.o_orderkey", "context.o_totalprice")


@query("context_missing", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def context_missing(spark: SparkSession, d: str) -> DataFrame:
    large = _order_contexts(spark, d).where(F.col("o_totalprice") > 400_000)
    missing = ctx.without_context(_named_customers(spark, d), large, "variety_name", "name")
    return missing.select("c_custkey")


@query("incremental_new", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def incremental_new(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").select("o_orderkey")
    done = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return ctx.not_yet_done(orders, done, ["o_orderkey"])


@query("analysis_payload", f"""WITH {_CONTEXT_SQL},
titles AS (SELECT v, query, '[' || string_agg('{{"rank":' || rank || ',"title":"t' || event_id || '","year":"' || year || '"}}', ',' ORDER BY rank) || ']' AS j
           FROM kept GROUP BY ALL),
entry AS (SELECT f.v, f.query_pos, f.type, f.error, '{{"query":"' || replace(f.query, '"', '\\"') || '","type":"' || f.type || '"'
                 || coalesce(',"results":' || t.j, '') || ',"count":' || f.n || ',"success":' || CASE WHEN f.success THEN 'true' ELSE 'false' END
                 || coalesce(',"error":"' || f.error || '"', '') || '}}' AS j
          FROM full_q f LEFT JOIN titles t ON f.v = t.v AND f.query = t.query)
SELECT v AS variety_name, '{{"variety_information":{{"variety_name":"' || v || '","crop_name":"rice"}},"search_results":['
       || string_agg(j, ',' ORDER BY query_pos) || '],"total_queries":' || count(*) || ',"successful_queries":' || count_if(error IS NULL)
       || ',"google_scholar_results":[' || string_agg(CASE WHEN type = 'google_scholar' THEN j END, ',' ORDER BY query_pos)
       || '],"google_search_results":[' || string_agg(CASE WHEN type = 'google_search' THEN j END, ',' ORDER BY query_pos) || ']}}' AS payload
FROM entry GROUP BY v""")
def analysis_payload(spark: SparkSession, d: str) -> DataFrame:
    context = _contexts(spark, d)
    payload = ctx.analysis_payload(F.struct("search_results"), F.col("variety_info"))
    return context.select("variety_info.variety_name", payload.alias("payload"))


@query("enriched_records", f"""WITH {_CONTEXT_SQL},
m AS (SELECT v, CAST(sum(n) AS INTEGER) AS total, count_if(error IS NULL) AS ok, CAST(substr(v, 5) AS BIGINT) AS u FROM full_q GROUP BY v)
SELECT upper(v) AS variety_name, total AS total_results, 30 AS total_search_queries, ok AS successful_queries,
       CASE u % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'High' END AS drought, CASE u % 4 WHEN 0 THEN 7 WHEN 1 THEN 7 END AS total_sources,
       CASE u % 4 WHEN 2 THEN 'reply is not a JSON object' WHEN 3 THEN 'empty reply' END AS error FROM m""")
def enriched_records(spark: SparkSession, d: str) -> DataFrame:
    """Contexts joined in another case, with replies that are plain, fenced, broken or missing."""
    number = F.substr("variety_name", F.lit(5)).cast("long")
    names = users(spark, d).select(F.upper("variety_name").alias("variety_name"), number.alias("u"))
    body = ('{"stress_tolerance_profile":{"drought_tolerance":{"tolerance_level":"High"}},'
            '"evidence_quality_assessment":{"total_sources":7}}')
    shapes = F.array(F.lit(body), F.lit(f"```json\n{body}\n```"), F.lit(body[:-9]), F.lit(None).cast("string"))
    replies = names.select("variety_name", F.get(shapes, (F.col("u") % 4).cast("int")).alias("reply_text"))
    contexts = _contexts(spark, d).withColumn("source_path", F.lit("a"))
    records = enrichment.enrich(names.drop("u"), contexts, replies, RUN_TS)
    a = "analysis_result."
    return records.select(
        "original_data.variety_name", "context_data.search_metadata.total_results",
        a + "processing_metadata.total_search_queries", a + "processing_metadata.successful_queries",
        F.col(a + "stress_tolerance_profile.drought_tolerance.tolerance_level").alias("drought"),
        a + "evidence_quality_assessment.total_sources", a + "error")
