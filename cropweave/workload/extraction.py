"""Links, table rows and reply records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.functions import jsonio
from cropweave.functions.text import slug
from cropweave.operators import extract
from cropweave.plans.extraction import extract_records
from cropweave.sources.readers import read_table, spread
from cropweave.workload.registry import query

RUN_TS = "2024-01-01T00:00:00"


@query("html_links", r"""
WITH t AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href,
                  unnest(regexp_extract_all(html, '<a href="[^"]*">(.*?)</a>', 1)) AS txt FROM pages)
SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || href AS link_url, trim(txt) AS link_text, '' AS link_title,
       'href' AS link_source FROM t""")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    links = extract.html_links(spread(read_table(spark, d, "pages")), suffix="")
    return links.select("page_id", "link_url", "link_text", "link_title", "link_source")


@query("document_links", """
SELECT c_custkey, 'http://m.example.org/a/files/' || c_custkey || '.PDF' AS link_url, c_name || ' & co' AS link_text,
       c_mktsegment AS link_title, 'href' AS link_source FROM customer
UNION ALL SELECT c_custkey, 'http://m.example.org/get/' || c_custkey || '.pdf?z=1', c_name, '', 'onclick' FROM customer""")
def document_links(spark: SparkSession, d: str) -> DataFrame:
    """Suffix links in ``href`` and ``onclick`` of markup written from every customer."""
    key = F.col("c_custkey").cast("string")
    html = F.concat(
        F.lit("<!-- <a href='old.pdf'>old</a> --><a class=x HREF='../files/"), key, F.lit(".PDF' title=\""), "c_mktsegment",
        F.lit('"> <b>'), "c_name", F.lit("</b> &amp; co</a><a href='page.html'>no</a><div onclick=\"open('/get/"), key,
        F.lit(".pdf?z=1', 'w')\">"), "c_name", F.lit("</div>"))
    pages = spread(read_table(spark, d, "customer")).select("c_custkey", F.lit("http://m.example.org/a/b/index.html?q=1").alias("url"),
                                                    html.alias("html"))
    links = extract.html_links(pages)
    text = F.replace("link_text", F.lit("& co"), F.lit(" & co"))
    return links.select("c_custkey", "link_url", F.regexp_replace(text, r"\s+", " ").alias("link_text"), "link_title",
                        "link_source")


@query("table_rows", """
WITH c AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer)
SELECT c_custkey, '1' AS sl_no, c_mktsegment AS crop_name, CAST(2000 + c_nationkey AS VARCHAR) AS year, CAST(c_nationkey AS VARCHAR) AS variety_count,
       'Punjab' AS state, unnest([c_name, 'PR-126', 'IR 64']) AS variety_name FROM c
UNION ALL SELECT c_custkey, '2', c_mktsegment, '2016', '', 'Punjab', 'HD ' || c_custkey || 'x' FROM c""")
def table_rows(spark: SparkSession, d: str) -> DataFrame:
    """Header, a row of several varieties, a plain row and a short row, written from every customer."""
    td = lambda *cells: [F.lit("<tr>"), *[p for c in cells for p in (F.lit("<td>"), c, F.lit("</td>"))], F.lit("</tr>")]
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    year = F.concat((F.lit(2000) + nation).cast("string"), F.lit("<br>("), nation.cast("string"), F.lit(")"))
    names = F.concat("c_name", F.lit(", PR-126;IR 64\nX1"))
    html = F.concat(F.lit("<table><tr><th>a</th></tr>"),
                    *td(F.lit("1"), F.col("c_mktsegment"), year, F.lit(" Punjab "), names),
                    *td(F.lit("2"), F.col("c_mktsegment"), F.lit("2016"), F.lit("Punjab"), F.concat(F.lit("HD "), key, F.lit("x"))),
                    *td(F.lit("3"), F.lit("too"), F.lit("few"), F.lit("cells")), F.lit("</table>"))
    pages = spread(read_table(spark, d, "customer")).select("c_custkey", html.alias("html"))
    rows = extract.registry_rows(extract.table_cells(pages))
    return rows.drop("row_pos", "value_pos")


@query("nested_table_rows", """
SELECT c_custkey, 1 AS "table", 0 AS parent, '1' AS sl_no, c_mktsegment AS crop_name, '2016' AS year, '' AS variety_count, 'Punjab' AS state, unnest([c_name, 'IR 64']) AS variety_name FROM customer
UNION ALL SELECT c_custkey, 1, 0, '2', c_mktsegment, '2017', '', 'Goa', 'HD ' || c_custkey FROM customer
UNION ALL SELECT c_custkey, 2, -1, '9', c_mktsegment, '2018', '', 'Bihar', 'last ' || c_nationkey FROM customer""")
def nested_table_rows(spark: SparkSession, d: str) -> DataFrame:
    """Tables in a cell, cells and rows without end tags, an unclosed table, written from every customer."""
    key = F.col("c_custkey").cast("string")
    html = F.concat(
        F.lit("<table><tr><td>outer <!-- <td> --> <TABLE class='a>b'><tr><th>no<th>crop</th><tr><td>1<td>"), "c_mktsegment",
        F.lit("<td>2016</td><td> Punjab <td>"), "c_name", F.lit(", IR&nbsp;64<tr><td>2<td>"), "c_mktsegment", F.lit("<td>2017<td>Goa<td><b>HD</b> "), key,
        F.lit("</table> rest<td>short</table><script>'<table>'</script><table><tr><th>h</th></tr><tr><td>9</td><td>"), "c_mktsegment",
        F.lit("</td><td>2018</td><td>Bihar</td><td>last "), F.col("c_nationkey").cast("string"))
    pages = spread(read_table(spark, d, "customer")).select("c_custkey", html.alias("html"))
    rows = extract.registry_rows(extract.nested_table_cells(pages))
    return rows.drop("row_pos", "value_pos").withColumn("variety_name", F.replace("variety_name", F.lit("\u00a0"), F.lit(" ")))


@query("nested_links", """
SELECT c_custkey, 'http://m.example.org/get/' || c_custkey || '.pdf' AS link_url, 'Minutes' || c_name || 'of' || c_mktsegment || 'end' AS link_text, 't' AS link_title, 'onclick' AS link_source FROM customer
UNION ALL SELECT c_custkey, 'http://m.example.org/in.pdf', c_name || 'of' || c_mktsegment, '', 'href' FROM customer
UNION ALL SELECT c_custkey, 'http://m.example.org/a/b/open.PDF', 'first', '', 'href' FROM customer
UNION ALL SELECT c_custkey, 'http://m.example.org/a/b/next.pdf', 'second & last', '', 'href' FROM customer""")
def nested_links(spark: SparkSession, d: str) -> DataFrame:
    """Clickable elements that hold elements of their kind and links without an end, written from every customer."""
    key = F.col("c_custkey").cast("string")
    html = F.concat(F.lit("<div onclick=\"open('/get/"), key, F.lit(".pdf')\" title=t> Minutes <div><a href=/in.pdf> "), "c_name",
                    F.lit(" <div>of</div> "), "c_mktsegment", F.lit("</a></div> end</div><p><a href='open.PDF'>first<a href=\"next.pdf\">second &amp; last"))
    pages = spread(read_table(spark, d, "customer")).select("c_custkey", F.lit("http://m.example.org/a/b/index.html").alias("url"), html.alias("html"))
    return extract.nested_links(pages).select("c_custkey", "link_url", "link_text", "link_title", "link_source")


def order_replies(spark: SparkSession, d: str) -> DataFrame:
    """One reply per order, in the eight shapes replies come in."""
    key = F.col("o_orderkey").cast("string")
    one = F.concat(F.lit('{"variety_name":"V'), key, F.lit('","crop_type":"'), "o_orderpriority", F.lit('","zzz":1}'))
    two = F.concat(F.lit('{"variety_name":"W}'), key, F.lit('","crop_type":"","maturity_group":null,"item_number":'), key, F.lit("}"))
    shapes: list[Column] = [
        F.concat(F.lit("["), one, F.lit(","), two, F.lit("]")),
        F.concat(F.lit("```json\n["), one, F.lit(","), two, F.lit("]\n```")),
        F.concat(F.lit("["), one, F.lit(","), two),
        F.concat(F.lit("["), one, F.lit(',{"variety_name":"W}')),
        one,
        F.concat(F.lit("["), one, F.lit(", 5]")),
        F.lit("sorry"),
        F.lit("[]"),
    ]
    shape = F.get(F.array(*shapes), (F.col("o_orderkey") % 8).cast("int"))
    return spread(read_table(spark, d, "orders")).select(F.concat(F.lit("in/doc "), key, F.lit(".pdf")).alias("doc_path"),
                                                 shape.alias("reply_text"))


def _record_sql() -> str:
    given = {"variety_name": "variety_name", "crop_type": "crop_type", "item_number": "item_number",
             "source_document_filename": "'doc ' || k || '.pdf'", "extraction_timestamp": f"'{RUN_TS}'"}
    columns = ", ".join(f"{given.get(f, repr('Not Specified'))} AS {f}" for f in extract.RECORD_FIELDS)
    return f"""
WITH r AS (SELECT o_orderkey AS k, 0 AS record_pos, 'V' || o_orderkey AS variety_name, o_orderpriority AS crop_type, 'Not Specified' AS item_number
           FROM orders WHERE o_orderkey % 8 IN (0, 1, 2, 3, 5)
           UNION ALL SELECT o_orderkey, 1, 'W}}' || o_orderkey, 'Not Specified', CAST(o_orderkey AS VARCHAR)
           FROM orders WHERE o_orderkey % 8 IN (0, 1, 2))
SELECT record_pos, 'AgriRegulatory_doc' || k || '_20240101_ExtractedData' AS document_key, {columns} FROM r"""


@query("reply_records", _record_sql())
def reply_records(spark: SparkSession, d: str) -> DataFrame:
    """All 65 columns of all records."""
    return extract_records(order_replies(spark, d), RUN_TS)


@query("reply_summary", """
SELECT count(*) AS total_documents, count_if(o_orderkey % 8 IN (0, 1, 2, 3, 5)) AS successful,
       count_if(o_orderkey % 8 IN (2, 3)) AS repaired, count_if(o_orderkey % 8 IN (4, 6, 7)) AS failed FROM orders""")
def reply_summary(spark: SparkSession, d: str) -> DataFrame:
    return extract.reply_summary(extract.parse_replies(order_replies(spark, d)))


@query("failed_documents", """
SELECT 'in/doc ' || o_orderkey || '.pdf' AS doc_path FROM orders WHERE o_orderkey % 8 IN (4, 6, 7)""")
def failed_documents(spark: SparkSession, d: str) -> DataFrame:
    parsed = extract.parse_replies(order_replies(spark, d))
    return parsed.where(F.col("status") == "failed").select("doc_path")


@query("json_arrays", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'view' THEN 1 WHEN event_type = 'click' THEN 0 ELSE 2 END AS size,
       CASE WHEN event_type IN ('error', 'click') THEN '' WHEN event_type = 'view' THEN 'view' ELSE event_type || ', ' || props END AS joined FROM events""")
def json_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Array cells: malformed, of one value, an object, null, of two values."""
    kind = F.col("event_type")
    cell = (F.when(kind == "error", F.concat(F.lit('["'), "props")).when(kind == "view", F.lit(' ["view"] '))
            .when(kind == "click", F.col("props")).otherwise(F.to_json(F.array("event_type", "props"))))
    array = jsonio.parse_string_array(cell)
    return read_table(spark, d, "events").select("event_id", jsonio.array_size(array).alias("size"),
                                                 F.array_join(array, ", ").alias("joined"))


@query("json_flatten", """
SELECT event_id, user_id AS "who.user_id", event_type AS "what.type", CAST(props ->> 'k' AS INTEGER) AS "what.props.k" FROM events""")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    nested = read_table(spark, d, "events").select(
        "event_id", F.struct("user_id").alias("who"),
        F.struct(F.col("event_type").alias("type"), F.from_json("props", "k int").alias("props")).alias("what"))
    return jsonio.flatten(nested)


@query("slugs", r"""
SELECT conv_id, turn, coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s-]', '', 'g'), '[-\s]+', '-', 'g'),
       '^-+|-+$', '', 'g'), 50), ''), 'Document') AS slug FROM conversations""")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "conversations").select("conv_id", "turn", slug("text").alias("slug"))
