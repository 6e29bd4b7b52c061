"""Readers, sinks and whole flows: what they write from the tables is read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.operators import quality, search, similar_sets, stats
from cropweave.plans import enrichment, publication, registries
from cropweave.session import shared_folder
from cropweave.sources import readers, versions, writers
from cropweave.sources.readers import read_table
from cropweave.workload.duplicates import enriched_parts
from cropweave.workload.quality import _LABELLED, _NAMES, _flagged
from cropweave.workload.registry import query

RUN_TS = "2024-01-01 00:00:00"


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/query-{uuid.uuid4().hex}"


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


_TEXT, _LONG = T.StringType(), T.LongType()


@query("registry_csv", r"""
WITH r AS (SELECT c_custkey AS src_pos, c_name AS variety, c_custkey % 6 AS cell FROM customer UNION ALL SELECT 10000000 + s_suppkey, s_name, s_suppkey % 6 FROM supplier)
SELECT 'CSC_' || lpad(CAST(row_number() OVER (ORDER BY src_pos) AS VARCHAR), 6, '0') AS csc_raw_id, lower(variety || ', "seed"' || chr(10) || 'x') AS variety_clean,
       CASE cell WHEN 0 THEN 2015 WHEN 1 THEN 2016 END AS year_extracted FROM r""")
def registry_csv(spark: SparkSession, d: str) -> DataFrame:
    """Two registry files with quotes and line breaks in cells, one after the other; years are cells of all sorts."""
    folder = new_folder(spark)
    name = lambda c: F.concat(F.col(c), F.lit(', "seed"\nx')).alias("variety")
    cell = lambda c: F.element_at(F.array(*map(F.lit, (" 2015 ", "2016.0", "NaN", "1e12", "text"))), (F.col(c) % 6 + 1).cast("int"))
    year = lambda c: F.when(F.col(c) % 6 < 5, cell(c)).alias("extracted_year")
    customers, suppliers = read_table(spark, d, "customer"), read_table(spark, d, "supplier")
    writers.write_csv(customers.select(F.col("c_custkey").alias("src_pos"), name("c_name"), year("c_custkey"), F.lit("x").alias("crop")), f"{folder}/a")
    writers.write_csv(suppliers.select((F.col("s_suppkey") + 10_000_000).alias("src_pos"), name("s_name"), year("s_suppkey"), F.lit("x").alias("crop")), f"{folder}/b")
    both = readers.read_registry_csv(spark, [f"{folder}/a", f"{folder}/b"], _schema(src_pos=_LONG, variety=_TEXT, extracted_year=_TEXT, crop=_TEXT))
    return registries.prepare_left(both.withColumnRenamed("variety", "variety_name")).select("csc_raw_id", "variety_clean", "year_extracted")


@query("json_array_documents", """
SELECT doc_id, CAST(doc_id // 100 AS BIGINT) AS batch, md5(text) AS digest FROM documents
UNION ALL SELECT NULL, NULL, md5('element is no object' || count(DISTINCT doc_id // 100)) FROM documents""")
def json_array_documents(spark: SparkSession, d: str) -> DataFrame:
    """All documents as arrays of a hundred or so, each with an element that is no object, read in small byte ranges."""
    folder = new_folder(spark)
    docs = read_table(spark, d, "documents").select("doc_id", F.floor(F.col("doc_id") / 100).alias("batch"), "text")
    element = F.to_json(F.struct("doc_id", "text", F.array(F.lit(","), F.lit('"]'), F.col("batch").cast("string")).alias("more")))
    arrays = docs.groupBy("batch").agg(F.concat(F.lit("[ 7, "), F.array_join(F.collect_list(element), ",\n"), F.lit(" ]")).alias("value"))
    arrays.select("value").repartition(8, F.xxhash64("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(folder)
    good, bad = readers.read_json_documents(spark, folder, _schema(doc_id=_LONG, text=_TEXT), split=50_000)
    found = good.select("doc_id", F.floor(F.col("doc_id") / 100).alias("batch"), F.md5(F.col("text").cast("binary")).alias("digest"))
    aside = bad.agg(F.md5(F.concat(F.max("reason"), F.count("*").cast("string")).cast("binary")).alias("digest"))
    return found.unionByName(aside, allowMissingColumns=True)


@query("final_fallback", "SELECT c_name AS variety_name, c_mktsegment AS crop_type, [c_mktsegment, 'a \"b\"'][1] || 'a \"b\"' AS joined FROM customer")
def final_fallback(spark: SparkSession, d: str) -> DataFrame:
    """The published catalogue from its CSV, as no table of it exists; array cells are parsed again."""
    folder = new_folder(spark)
    writers.write_csv(read_table(spark, d, "customer").select(
        F.col("c_name").alias("variety_name"), F.col("c_mktsegment").alias("crop_type"),
        F.array("c_mktsegment", F.lit('a "b"')).alias("data_sources")), folder, quote_all=True)
    final = readers.read_final(spark, "no_such_table", folder, _schema(variety_name=_TEXT, crop_type=_TEXT, data_sources=_TEXT))
    return final.select("variety_name", "crop_type", F.array_join("data_sources", "").alias("joined"))


@query("document_listing", """
SELECT CAST(sum(strlen(html) + 1) AS BIGINT) AS total_bytes, true AS all_oversize, true AS in_order FROM pages""")
def document_listing(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder by suffix, in order of their names, with size and oversize flag; other files are left out."""
    folder = new_folder(spark)
    pages = read_table(spark, d, "pages").select("html")
    pages.repartition(8).write.text(folder)
    pages.limit(0).write.mode("append").json(folder)
    files = readers.list_documents(spark, folder, suffix="TXT", limit_bytes=1)
    names = files.agg(F.collect_list("file_name").alias("n"), F.sum("length").alias("total_bytes"), F.every("oversize").alias("all_oversize"))
    return names.select("total_bytes", "all_oversize", (F.col("n") == F.array_sort("n")).alias("in_order"))


@query("extraction_csv", """
SELECT 'DOC_' || (l_orderkey % 50) AS document_key, l_orderkey AS record_pos, CAST(sum(l_linenumber) AS BIGINT) AS lines,
       'say "' || min(l_returnflag) || '", ok' AS note FROM lineitem GROUP BY l_orderkey""")
def extraction_csv(spark: SparkSession, d: str) -> DataFrame:
    """Extraction records in buckets by document key, every cell quoted, read back whole."""
    folder = new_folder(spark)
    records = read_table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("record_pos")).agg(
        F.sum("l_linenumber").cast("long").alias("lines"), F.format_string('say "%s", ok', F.min("l_returnflag")).alias("note"))
    keyed = records.select(F.concat(F.lit("DOC_"), (F.col("record_pos") % 50).cast("string")).alias("document_key"), "record_pos", "lines", "note")
    writers.write_records(keyed, folder, "document_key")
    return readers.read_registry_csv(spark, folder, _schema(document_key=_TEXT, record_pos=_LONG, lines=_LONG, note=_TEXT)).select(
        "document_key", "record_pos", "lines", "note")


_REGISTRIES = """
l AS (SELECT p_partkey AS src_pos, p_name, lower(p_type) AS crop, p_brand, p_name || ' ' || p_size % 5 AS key FROM part WHERE p_partkey % 2 = 0),
r AS (SELECT p_partkey AS src_pos, lower(p_type) AS crop, 'The ' || p_brand AS institution, p_name || ' ' || p_size % 5 AS key FROM part WHERE p_partkey % 2 = 1),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY crop, key ORDER BY src_pos) = 1),
m AS (SELECT 'CSC_' || lpad(CAST(row_number() OVER (ORDER BY l.src_pos) AS VARCHAR), 6, '0') AS csc_raw_id, l.key, b.key IS NOT NULL AS found,
             CASE WHEN b.key IS NOT NULL THEN coalesce(len(list_intersect(string_split(lower(replace(p_brand, '#', ' ')), ' '), string_split(lower(replace(institution, '#', ' ')), ' ')))
               / CAST(len(list_distinct(string_split(lower(replace(p_brand, '#', ' ')), ' ') || string_split(lower(replace(institution, '#', ' ')), ' '))) AS DOUBLE) >= 0.5, false) END AS agrees
      FROM l LEFT JOIN b ON l.crop = b.crop AND l.key = b.key)"""


def _matched(spark: SparkSession, d: str, folder: str) -> DataFrame:
    parts = read_table(spark, d, "part").select(
        F.col("p_partkey").alias("src_pos"), F.concat("p_name", F.lit(" "), (F.col("p_size") % 5).cast("string")).alias("variety_name"),
        F.col("p_type").alias("crop_type"), F.col("p_brand").alias("institution"))
    left, right = parts.where("src_pos % 2 = 0"), parts.where("src_pos % 2 = 1").withColumn("institution", F.concat(F.lit("The "), "institution"))
    return registries.run(left, right, folder, RUN_TS, threshold=100, sample=10)


@query("match_outputs", f"""WITH {_REGISTRIES}
SELECT csc_raw_id, key AS csc_variety_clean, CASE WHEN found THEN 'MATCHED' ELSE 'UNMATCHED' END AS match_status, CASE WHEN found THEN 100 ELSE 0 END AS similarity_score,
       agrees AS institution_agrees FROM m""")
def match_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Written matches of two registries; matched pairs tell whether their institutions agree."""
    return _matched(spark, d, new_folder(spark)).select("csc_raw_id", "csc_variety_clean", "match_status", "similarity_score", "institution_agrees")


@query("match_files", f"""WITH {_REGISTRIES}
SELECT 'matched' AS file, least(10, count_if(found)) AS n FROM m UNION ALL SELECT 'unmatched', least(10, count_if(NOT found)) FROM m
UNION ALL SELECT 'report', count_if(found) FROM m UNION ALL SELECT 'left', count(*) FROM l UNION ALL SELECT 'right', count(*) FROM r""")
def match_files(spark: SparkSession, d: str) -> DataFrame:
    """The files beside the matches: review samples, report, snapshot of the inputs."""
    folder = new_folder(spark)
    _matched(spark, d, folder)
    count = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("file"), "n")
    found = [count(s, spark.read.option("header", True).csv(f"{folder}/manual_review/{s}_sample")) for s in ("matched", "unmatched")]
    found.append(spark.read.schema("matched_varieties long").json(f"{folder}/reports").select(F.lit("report").alias("file"), F.col("matched_varieties").alias("n")))
    for side in ("left", "right"):
        found.append(count(side, spark.read.parquet(f"{folder}/raw_data/{side}")))
    out = found[0]
    for frame in found[1:]:
        out = out.unionByName(frame)
    return out


@query("context_batches", """
SELECT c_name AS variety_name, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS batch FROM customer WHERE c_custkey % 3 < 2""")
def context_batches(spark: SparkSession, d: str) -> DataFrame:
    """Context documents in two batches; the second is given the varieties of the first once more and skips them."""
    folder = new_folder(spark)
    varieties = read_table(spark, d, "customer").select(F.col("c_name").alias("variety_name"), F.col("c_mktsegment").alias("crop_name"), "c_custkey")
    hits = read_table(spark, d, "orders").select(
        F.format_string("Customer#%09d", "o_custkey").alias("variety_name"), F.lit("q").alias("query"), F.lit("google_search").alias("type"),
        F.col("o_orderkey").alias("result_pos"), F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"),
        *[F.lit("x").alias(f) for f in enrichment.RESULT_FIELDS])
    for batch, last in ((1, 0), (2, 1)):
        enrichment.run_context(varieties.where(F.col("c_custkey") % 3 <= last).drop("c_custkey"), hits, folder, RUN_TS, batch)
    return spark.read.schema("variety_info struct<variety_name:string>, batch int").json(f"{folder}/contexts").select("variety_info.variety_name", "batch")


@query("catalogue_versions", """
SELECT 1 AS number, 'part' AS "table", count(*) AS n FROM part WHERE p_size <= 25 UNION ALL SELECT 1, 'details', 5 * count(*) FROM part WHERE p_size <= 25
UNION ALL SELECT 2, 'part', count(*) FROM part UNION ALL SELECT 2, 'details', 5 * count(*) FROM part
UNION ALL SELECT 3, 'part', count(*) FROM part UNION ALL SELECT 3, 'details', 5 * count(*) FROM part""")
def catalogue_versions(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of parent and child table, and a run that ends between both; number 3 is the newest a reader gets."""
    root = new_folder(spark)
    parts = read_table(spark, d, "part")

    def tables(rows: DataFrame, broken: bool = False):
        def write(folder: str) -> None:
            rows.write.parquet(f"{folder}/part")
            if broken:
                raise RuntimeError("ended half-way")
            rows.select("p_partkey", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("i")).write.parquet(f"{folder}/details")
        return write

    versions.publish(root, "2024-01-01", tables(parts.where("p_size <= 25")))
    versions.publish(root, "2024-02-01", tables(parts))
    try:
        versions.publish(root, "2024-03-01", tables(parts.where("p_size > 40"), broken=True))
    except RuntimeError:
        pass
    out = None
    for number, as_of in ((1, "2024-01-15"), (2, "2024-02-01"), (3, None)):
        for table in ("part", "details"):
            row = versions.read_version(spark, root, table, as_of).agg(F.count("*").alias("n")).select(
                F.lit(number).alias("number"), F.lit(table).alias("table"), "n")
            out = row if out is None else out.unionByName(row)
    return out


@query("variety_details", """
WITH s AS (SELECT *, CASE WHEN p_size > 35 THEN 'high' WHEN p_size > 15 THEN 'medium' END AS graded FROM part WHERE p_partkey % 4 <> 0),
k AS (SELECT unnest(['drought_tolerance', 'heat_tolerance', 'salinity_tolerance', 'flood_tolerance', 'submergence_tolerance',
             'disease_resistance', 'pest_resistance']) AS stress_type, unnest([0, 1, 0, 1, 0, 1, 0]) AS g),
j AS (SELECT p_partkey AS variety_id, p_name AS variety_name, stress_type, CASE WHEN g = 1 THEN graded ELSE lower(p_type) END AS tolerance_level FROM s, k)
SELECT row_number() OVER (ORDER BY variety_id, stress_type) AS tolerance_id, * FROM j WHERE tolerance_level IS NOT NULL""")
def variety_details(spark: SparkSession, d: str) -> DataFrame:
    """Varieties joined with their tolerance details after both were written; details of missing varieties stand aside."""
    parents = read_table(spark, d, "part").where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("variety_id"), F.col("p_name").alias("variety_name"))
    details = publication.tolerance_details(enriched_parts(spark, d), "src_pos")
    varieties, children = publication.export_tables(parents, details, new_folder(spark))
    return varieties.join(children, "variety_id").select("tolerance_id", "variety_id", "variety_name", "stress_type", "tolerance_level")


@query("reconcile_sources", """
WITH a AS (SELECT nullif(o_orderkey, 7) AS k, o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
b AS (SELECT CASE WHEN l_orderkey % 100 <> 1 THEN l_orderkey END AS k, max(l_linestatus) AS status, CAST(year(min(l_shipdate)) AS INTEGER) AS y FROM lineitem WHERE l_orderkey % 100 <> 1 OR l_orderkey = 101 GROUP BY 1),
c AS (SELECT o_orderkey AS k, nullif(o_orderstatus, 'P') AS status, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderkey % 3 = 0),
j AS (SELECT coalesce(a.k, b.k, c.k) AS k, a.k IS NOT NULL AS ia, b.k IS NOT NULL AS ib, c.k IS NOT NULL AS ic,
        a.status AS sa, b.status AS sb, c.status AS sc, a.y AS ya, b.y AS yb, c.y AS yc
      FROM (SELECT * FROM a WHERE k IS NOT NULL) a FULL JOIN (SELECT * FROM b WHERE k IS NOT NULL) b ON a.k = b.k FULL JOIN c ON coalesce(a.k, b.k) = c.k
      UNION ALL SELECT NULL, true, false, false, status, NULL, NULL, y, NULL, NULL FROM a WHERE k IS NULL
      UNION ALL SELECT NULL, false, true, false, NULL, status, NULL, NULL, y, NULL FROM b WHERE k IS NULL),
d AS (SELECT *, CASE WHEN ia THEN sa WHEN ib THEN sb ELSE sc END AS s1, CASE WHEN ia THEN ya WHEN ib THEN yb ELSE yc END AS y1 FROM j),
e AS (SELECT *, CASE WHEN ib AND sb IS DISTINCT FROM s1 THEN 'lines' WHEN ic AND sc IS DISTINCT FROM s1 THEN 'copy' END AS status_differs_in,
        CASE WHEN ib AND yb IS DISTINCT FROM y1 THEN 'lines' WHEN ic AND yc IS DISTINCT FROM y1 THEN 'copy' END AS y_differs_in FROM d)
SELECT k, concat_ws('+', CASE WHEN ia THEN 'orders' END, CASE WHEN ib THEN 'lines' END, CASE WHEN ic THEN 'copy' END) AS found_in,
       status_differs_in IS NULL AS status_agrees, status_differs_in, y_differs_in IS NULL AS y_agrees, y_differs_in FROM e""")
def reconcile_sources(spark: SparkSession, d: str) -> DataFrame:
    """Three sources of the same key, some of it null."""
    orders, lines = read_table(spark, d, "orders"), read_table(spark, d, "lineitem")
    year = lambda c: F.year(c).alias("y")
    a = orders.select(F.nullif("o_orderkey", F.lit(7)).alias("k"), F.col("o_orderstatus").alias("status"), year("o_orderdate"))
    b = (lines.where("l_orderkey % 100 <> 1 OR l_orderkey = 101").groupBy(F.when(F.col("l_orderkey") % 100 != 1, F.col("l_orderkey")).alias("k"))
         .agg(F.max("l_linestatus").alias("status"), F.year(F.min("l_shipdate")).alias("y")))
    c = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"), F.nullif("o_orderstatus", F.lit("P")).alias("status"), year("o_orderdate"))
    found = quality.reconcile({"orders": a, "lines": b, "copy": c}, "k", ["status", "y"])
    return found.withColumn("found_in", F.array_join("found_in", "+")).drop("missing_in", "repeated_in")


@query("search_index", f"""WITH {_LABELLED}
SELECT 'state' AS search, doc_id FROM s WHERE lang = 'en' AND list_contains(words, 'a') AND round(score, 6) >= 0.8
UNION ALL SELECT 'stressors', doc_id FROM s WHERE source = 'src3' AND list_has_any(words, ['b', 'c']) AND round(score, 6) >= 0.6
UNION ALL SELECT 'both', doc_id FROM s WHERE list_contains(words, 'a') AND list_has_any(words, ['b', 'c'])
UNION ALL SELECT 'crop', doc_id FROM s WHERE lang = 'fr' AND source = 'src1'""")
def search_index(spark: SparkSession, d: str) -> DataFrame:
    """Searches through the inverted table that is stored with a catalogue."""
    path = new_folder(spark)
    terms = {"state": "words", "stressor": "words", "crop": "lang", "institution": "source"}
    kept = {k: _NAMES[k] for k in ("crop", "institution", "score", "flag")}
    search.write_index(_flagged(spark, d), path, "doc_id", terms, kept)
    found = {"state": search.search_index(spark, path, crop="en", state="a", flags=["good"]),
             "stressors": search.search_index(spark, path, institution="src3", stressors=["b", "c"], min_score=0.6),
             "both": search.search_index(spark, path, state="a", stressors=["b", "c"]),
             "crop": search.search_index(spark, path, crop="fr", institution="src1")}
    out = None
    for name, frame in found.items():
        rows = frame.select(F.lit(name).alias("search"), F.col("id").alias("doc_id"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("grown_profile", """
WITH h AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus, CASE WHEN o_orderkey % 3 < 2 THEN o_custkey END AS o_custkey FROM orders)
SELECT 'o_orderkey' AS column_name, 'bigint' AS dtype, count(*) - count(o_orderkey) AS missing_values, true AS close FROM h
UNION ALL SELECT 'o_orderstatus', 'string', count(*) - count(o_orderstatus), true FROM h
UNION ALL SELECT 'o_custkey', 'bigint', count(*) - count(o_custkey), true FROM h""")
def grown_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile of orders that come in three batches, one of them twice and one without a column; distinct values are close to exact."""
    path = new_folder(spark)
    orders = read_table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"), "o_custkey")
    for batch in (0, 1, 1):
        stats.add_batch(orders.where(F.col("o_orderkey") % 3 == batch), path, f"b{batch}")
    stats.add_batch(orders.where("o_orderkey % 3 = 2").drop("o_custkey"), path, "b2")
    grown = stats.grown_profile(spark.read.parquet(path))
    kept = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 < 2, F.col("o_custkey")))
    exact = stats.unique_counts(kept, kept.columns).withColumnRenamed("unique_values", "exact")
    # four standard errors
    return grown.join(exact, "column_name").select("column_name", "dtype", "missing_values", (
        F.abs(F.col("unique_values") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.033 * F.col("exact"))).alias("close"))


_WORD_SETS = r"""
k AS (SELECT DISTINCT lower(trim(regexp_replace(p_name || ' ' || p_brand, '\W', ' ', 'g'))) AS a,
             lower(trim(regexp_replace(p_type || ' ' || p_brand || ' ' || string_split(p_name, ' ')[-1] || ' ' || string_split(p_name, ' ')[1], '\W', ' ', 'g'))) AS b FROM part),
l AS (SELECT DISTINCT a AS left_key, list_distinct(list_filter(string_split(a, ' '), lambda x: x <> '')) AS x FROM k),
r AS (SELECT DISTINCT b AS right_key, list_distinct(list_filter(string_split(b, ' '), lambda x: x <> '')) AS y FROM k)"""


@query("similar_sets", f"""WITH {_WORD_SETS},
p AS (SELECT left_key, right_key, CAST(len(list_intersect(x, y)) AS BIGINT) AS shared, CAST(len(list_distinct(x || y)) AS BIGINT) AS weight FROM l, r)
SELECT *, round(shared / CAST(weight AS DOUBLE), 6) AS similarity FROM p WHERE 100 * shared >= 75 * weight""")
def similar_names(spark: SparkSession, d: str) -> DataFrame:
    """Part names against names with the same words in another order and one word more."""
    parts = read_table(spark, d, "part")
    words = F.split("p_name", " ")
    swapped = F.concat_ws(" ", "p_type", "p_brand", F.element_at(words, -1), F.element_at(words, 1))
    found = similar_sets.similar_sets(parts.select(F.concat_ws(" ", "p_name", "p_brand").alias("a")), parts.select(swapped.alias("b")),
                                      left_name="a", right_name="b", percent=75)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("published_version", """
SELECT count(*) AS input_rows, true AS all_tables, true AS found_by_index FROM part""")
def published_version(spark: SparkSession, d: str) -> DataFrame:
    """The whole publication in a version: its tables belong together, and its index finds the rows of a crop."""
    root = new_folder(spark)
    commit = publication.publish(enriched_parts(spark, d), root, RUN_TS)
    tables = {"catalogue", "details", "search_index", "summary_report", "duplicates_analysis", "classified"} <= set(commit["tables"])
    folder = versions.version_folder(root)
    published = versions.read_version(spark, root, "catalogue")
    by_index = search.search_index(spark, f"{folder}/search_index", crop="Small").agg(F.count("*")).scalar()
    by_scan = published.where("crop_type = 'Small'").agg(F.count("*")).scalar()
    return spark.read.parquet(f"{folder}/classified").agg(F.count("*").alias("input_rows")).select(
        "input_rows", F.lit(tables).alias("all_tables"), (by_index == by_scan).alias("found_by_index"))
