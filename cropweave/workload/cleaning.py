"""Cleaning, ids and text-derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.functions import labels, text
from cropweave.operators import columns, counts
from cropweave.operators.ordering import id_check, with_sequential_id
from cropweave.sources.readers import read_table, spread
from cropweave.workload.registry import query


@query("clean_keys", r"""
WITH c AS (SELECT c_custkey, '  ' || c_name || chr(9) AS name, nullif(c_mktsegment, 'BUILDING') AS crop FROM customer
           UNION ALL SELECT p_partkey, CASE WHEN p_size > 25 THEN '   ' ELSE p_name END, p_type FROM part)
SELECT c_custkey, lower(trim(name, ' ' || chr(9))) AS variety_clean, lower(crop) AS crop_clean,
       name AS variety_original, crop AS crop_original
FROM c WHERE trim(name, ' ' || chr(9)) <> ''""")
def clean_keys(spark: SparkSession, d: str) -> DataFrame:
    named = read_table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit("\t")).alias("name"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("crop"))
    parts = read_table(spark, d, "part").select(
        F.col("p_partkey").alias("c_custkey"),
        F.when(F.col("p_size") > 25, F.lit("   ")).otherwise(F.col("p_name")).alias("name"), F.col("p_type").alias("crop"))
    keyed = columns.registry_keys(named.unionByName(parts), "name", "crop")
    return keyed.select("c_custkey", "variety_clean", "crop_clean", "variety_original", "crop_original")


@query("trim_title_fill", r"""
SELECT c_custkey, list_reduce(list_prepend('', regexp_extract_all(c_name, '([a-zA-Z]+|[^a-zA-Z]+)')),
         lambda a, t: a || upper(substr(t, 1, 1)) || lower(substr(t, 2))) AS c_name,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown') AS c_mktsegment, c_nationkey FROM customer""")
def trim_title_fill(spark: SparkSession, d: str) -> DataFrame:
    raw = read_table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("\t"), F.upper("c_name"), F.lit(" ")).alias("c_name"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"), "c_nationkey")
    return columns.fill_marker(columns.title_named(columns.trim_strings(raw)), ["c_mktsegment", "absent"])


@query("title_case", r"""
SELECT p_partkey, list_reduce(list_prepend('', regexp_extract_all(p_name || '-' || p_type || p_size || 'x', '([a-zA-Z]+|[^a-zA-Z]+)')),
         lambda a, t: a || upper(substr(t, 1, 1)) || lower(substr(t, 2))) AS titled FROM part""")
def title_case(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat("p_name", F.lit("-"), "p_type", F.col("p_size").cast("string"), F.lit("x"))
    return read_table(spark, d, "part").select("p_partkey", text.title_case(name).alias("titled"))


@query("row_ids", """
SELECT c_custkey, 'CSC_' || lpad(CAST(row_number() OVER (ORDER BY c_custkey) AS VARCHAR), 6, '0') AS csc_raw_id FROM customer""")
def row_ids(spark: SparkSession, d: str) -> DataFrame:
    return with_sequential_id(read_table(spark, d, "customer").select("c_custkey"), ["c_custkey"], "csc_raw_id", "CSC_")


@query("final_ids", """
SELECT o_orderkey, 'STS_' || lpad(CAST(row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS VARCHAR), 6, '0')
  AS variety_id FROM orders""")
def final_ids(spark: SparkSession, d: str) -> DataFrame:
    """Several sort columns; ids come from the starts of key ranges."""
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    ordered = with_sequential_id(orders, ["o_orderpriority", "o_orderdate", "o_orderkey"], "variety_id", "STS_")
    return ordered.select("o_orderkey", "variety_id")


@query("id_check", """
SELECT count(*) AS total_rows, count(DISTINCT l_orderkey * 100 + l_linenumber) AS unique_ids,
       count(*) = count(DISTINCT l_orderkey * 100 + l_linenumber) AS is_unique FROM lineitem""")
def check_ids(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"))
    return id_check(lines, "id")


@query("year_extract", r"""
SELECT o_orderkey, CAST(nullif(regexp_extract(o_orderpriority || ' ' || strftime(o_orderdate, '%Y-%m-%d'), '\b((?:19|20)\d{2})\b', 1), '') AS INTEGER)
         AS year_in_text,
       CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE CAST(strftime(o_orderdate, '%Y') AS INTEGER) END AS first_year,
       TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS DOUBLE) AS number
FROM orders""")
def year_extract(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = read_table(spark, d, "orders").withColumn("words", F.concat_ws(" ", "o_orderpriority", day))
    hidden = F.when(F.col("o_orderkey") % 5 >= 2, F.concat(F.lit("GO 120151 of "), day))
    return orders.select("o_orderkey", text.year_in_text("words").alias("year_in_text"),
                         text.first_year([F.lit("no year"), hidden]).alias("first_year"),
                         text.to_number(F.when(F.col("o_orderstatus") == "F", F.lit("n/a"))
                                        .otherwise(F.col("o_custkey").cast("string")))
                         .alias("number"))


@query("name_features", r"""
WITH n AS (SELECT p_partkey, initcap_name || ' C.v. ' || upper(replace(p_brand, '#', '-')) || p_size AS name
           FROM (SELECT *, upper(p_name) AS initcap_name FROM part)
           UNION ALL SELECT s_suppkey + 1000000000, upper(replace(s_name, '#', '-')) FROM supplier
           UNION ALL SELECT c_custkey + 2000000000, CAST(c_custkey AS VARCHAR) FROM customer)
SELECT p_partkey, coalesce(nullif(trim(regexp_extract(name, '^([A-Za-z\s]+)', 1)), ''), 'Unknown') AS crop_name,
       coalesce(nullif(regexp_extract(name, '([A-Z]+)-', 1), ''), 'Unknown') AS prefix,
       coalesce(nullif(regexp_extract(name, '(\d+)', 1), ''), 'Unknown') AS numeric_id,
       coalesce(nullif(regexp_extract(name, '([cvCV]\.?[vV]?\.?)', 1), ''), 'Unknown') AS abbreviation FROM n""")
def name_features(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part").select("p_partkey", F.concat(
        F.upper("p_name"), F.lit(" C.v. "), F.upper(F.replace("p_brand", F.lit("#"), F.lit("-"))),
        F.col("p_size").cast("string")).alias("name"))
    supplier = read_table(spark, d, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("p_partkey"),
        F.upper(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("name"))
    customer = read_table(spark, d, "customer").select(
        (F.col("c_custkey") + 2_000_000_000).alias("p_partkey"), F.col("c_custkey").cast("string").alias("name"))
    names = part.unionByName(supplier).unionByName(customer)
    return names.select("p_partkey", text.name_features("name").alias("f")).select("p_partkey", "f.*")


@query("group_lookup", """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VEHICLES' WHEN 'MACHINERY' THEN 'TOOLS' ELSE 'CEREALS' END
  AS crop_group FROM customer""")
def group_lookup(spark: SparkSession, d: str) -> DataFrame:
    table = {"AUTOMOBILE": "VEHICLES", "MACHINERY": "TOOLS"}
    return read_table(spark, d, "customer").select(
        "c_custkey", labels.crop_group(F.lower("c_mktsegment"), table).alias("crop_group"))


@query("split_explode", r"""
SELECT doc_id, value FROM (SELECT doc_id, unnest(list_transform(regexp_split_to_array(text, '[,;\n]'),
       lambda v: regexp_replace(v, '^\s+|\s+$', '', 'g'))) AS value FROM documents) WHERE length(value) > 2""")
def split_explode(spark: SparkSession, d: str) -> DataFrame:
    return spread(read_table(spark, d, "documents")).select("doc_id", F.explode(text.split_values("text")).alias("value"))


@query("link_names", r"""
WITH t AS (SELECT o_orderkey, o_orderpriority || ' notice: ' || CASE WHEN o_orderstatus = 'O' THEN 'undated'
             ELSE strftime(o_orderdate, '%Y_%-m-%-d') END AS txt, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
           FROM orders)
SELECT o_orderkey, 'CSC-Meeting_' || coalesce(day, '2024-01-01') || '_' || left(trim(regexp_replace(regexp_replace(txt, '[^\w\s-]', '', 'g'), '[-\s]+', '-', 'g'), '-'), 50)
       || '.pdf' AS file_name,
       'AgriRegulatory_' || CASE WHEN o_orderstatus = 'O' THEN 'order' || o_orderkey ELSE regexp_replace(o_orderpriority, '[^\p{L}\p{N}_-]', '', 'g') END
       || '_' || coalesce(day, '2024-01-01') || '_ExtractedData' AS document_key
FROM t JOIN (SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders) USING (o_orderkey)""")
def link_names(spark: SparkSession, d: str) -> DataFrame:
    open_order = F.col("o_orderstatus") == "O"
    written = F.when(open_order, F.lit("undated")).otherwise(F.date_format("o_orderdate", "yyyy_M-d"))
    label = F.concat("o_orderpriority", F.lit(" notice: "), written)
    day = text.date_in_text(label, F.lit("2024-01-01"))
    number = F.when(open_order, F.lit("Unknown")).otherwise(F.col("o_orderpriority"))
    stem = F.concat(F.lit("or.der"), F.col("o_orderkey").cast("string"), F.lit(".pdf"))
    return read_table(spark, d, "orders").select(
        "o_orderkey", text.link_file_name(label, F.lit(None).cast("string"), F.lit("2024-01-01")).alias("file_name"),
        text.document_key(number, stem, day).alias("document_key"))


@query("derived_classes", """
SELECT p_partkey, CASE WHEN p_size < 15 THEN 'Early' WHEN p_size < 35 THEN 'Medium' ELSE 'Late' END AS maturity_group,
       CASE WHEN p_retailprice > 1500 THEN 'Hybrid' WHEN p_name LIKE '%ring%' THEN 'Selection' ELSE 'Improved' END AS variety_type,
       CASE WHEN p_type = 'ECONOMY' THEN 'Public' WHEN p_type = 'LARGE' THEN 'Private' ELSE 'Other' END AS institution_type,
       CASE p_brand WHEN 'Brand#1' THEN 'first' ELSE lower(p_brand) END AS state_zone_standardized FROM part""")
def derived_classes(spark: SparkSession, d: str) -> DataFrame:
    method = F.replace("p_name", F.lit("ring"), F.lit(" Selection "))
    return read_table(spark, d, "part").select(
        "p_partkey", labels.maturity_group("p_size", 15, 35).alias("maturity_group"),
        labels.variety_type(F.col("p_retailprice") > 1500, method).alias("variety_type"),
        labels.keyword_class("p_type", [("economy", "Public"), ("large", "Private")], "Other").alias("institution_type"),
        labels.standard_state(F.concat(F.lit(" "), "p_brand"), {"brand#1": "first"}).alias("state_zone_standardized"))


@query("group_cap", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) <= 100""")
def group_cap(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem")
    capped = counts.cap_per_group(lines, "l_returnflag", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 100)
    return capped.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("label_truncate", """
SELECT doc_id, CASE WHEN length(source || ' ' || lang || ' ' || n_chars) > 10
       THEN left(source || ' ' || lang || ' ' || n_chars, 10) || '...' ELSE source || ' ' || lang || ' ' || n_chars END AS label FROM documents""")
def label_truncate(spark: SparkSession, d: str) -> DataFrame:
    full = F.concat_ws(" ", "source", "lang", F.col("n_chars").cast("string"))
    return read_table(spark, d, "documents").select("doc_id", text.truncate_label(full, 10).alias("label"))


@query("stamped", """
SELECT s_suppkey, 'supplier' AS data_source, '2024-01-01T00:00:00' AS extraction_timestamp FROM supplier""")
def stamped(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "supplier").select("s_suppkey")
    return columns.stamp(rows, data_source="supplier", extraction_timestamp="2024-01-01T00:00:00")
