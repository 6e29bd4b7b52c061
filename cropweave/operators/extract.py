"""Records out of HTML, table cells and JSON replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions import markup, urls
from cropweave.functions.jsonio import is_json_object, repair_array, strip_fences
from cropweave.functions.text import split_values, strip, year_cell
from cropweave.operators.columns import conform

# The extraction record, group by group.
DOCUMENT_FIELDS = (
    "source_document_filename", "document_id", "document_date", "document_publication_date", "meeting_number",
    "meeting_title", "chairman_name", "member_secretary", "meeting_location",
)
PROCESS_FIELDS = (
    "extraction_timestamp", "item_number", "table_source", "entry_sequence", "approval_status", "decision_date",
    "effective_date", "gazette_notification_reference",
)
VARIETY_FIELDS = (
    "crop_category", "crop_type", "variety_name", "variety_code", "alternate_names", "hybrid_indicator",
    "release_type", "maturity_group", "special_traits", "breeding_method",
)
GEOGRAPHY_FIELDS = (
    "recommended_states", "agro_climatic_zones", "excluded_areas", "soil_type_suitability",
    "rainfall_requirements", "temperature_tolerance",
)
INSTITUTION_FIELDS = (
    "sponsoring_institution", "institution_type", "institution_location", "principal_investigator",
    "collaborating_institutions", "funding_source", "development_period", "testing_locations",
)
TECHNICAL_FIELDS = (
    "parent_material", "breeding_program", "testing_duration", "yield_performance", "quality_parameters",
    "disease_resistance", "pest_tolerance",
)
REGULATORY_FIELDS = (
    "notification_requirements", "seed_sample_submission", "dna_fingerprinting",
    "morphological_characterization", "package_of_practices", "intellectual_property_status",
)
STATUS_FIELDS = (
    "deferment_reason", "rejection_reason", "missing_documents", "follow_up_action", "responsible_party",
)
CONTEXT_FIELDS = (
    "preceding_context", "table_caption", "additional_notes", "page_reference", "cross_references",
    "historical_context",
)
RECORD_FIELDS = (*DOCUMENT_FIELDS, *PROCESS_FIELDS, *VARIETY_FIELDS, *GEOGRAPHY_FIELDS, *INSTITUTION_FIELDS,
                 *TECHNICAL_FIELDS, *REGULATORY_FIELDS, *STATUS_FIELDS, *CONTEXT_FIELDS)


def html_links(pages: DataFrame, url: str = "url", html: str = "html", suffix: str = ".pdf") -> DataFrame:
    """Links of a page whose ``href`` ends in ``suffix`` and links named in ``onclick`` handlers.

    One row per link, no de-duplication: page columns but the HTML, then link_source, link_url, link_text, link_title.
    """
    keep = [c for c in pages.columns if c != html]
    wanted = suffix.lower()
    # Pages without the suffix never reach the tag patterns.
    hits = pages.where(F.contains(F.lower(html), F.lit(wanted))) if wanted else pages
    clean = urls.visible_html(html)
    # An element's text ends at the next tag of its kind, so an unclosed link hides no other link.
    anchors = F.regexp_extract_all(clean, F.lit(rf"(?is)(<a\b{urls.TAG_REST}.*?)(?=</?a\b|$)"), F.lit(1))
    clickable = F.regexp_extract_all(
        clean, F.lit(rf"(?is)(<(?:a|div)\b(?=[^>]*\bonclick\b){urls.TAG_REST}.*?)(?=</?(?:a|div)\b|$)"), F.lit(1))

    def parts(element: Column, source: str) -> Column:
        whole_tag = rf"(?s)^(<\w+{urls.TAG_REST})"
        tag = F.regexp_extract(element, whole_tag, 1)
        body = F.regexp_replace(element, whole_tag, "")
        raw = urls.attribute(tag, "href" if source == "href" else "onclick")
        return F.struct(F.lit(source).alias("source"), raw.alias("raw"), urls.inner_text(body).alias("text"),
                        F.coalesce(urls.attribute(tag, "title"), F.lit("")).alias("title"))

    found = F.concat(F.transform(anchors, lambda e: parts(e, "href")), F.transform(clickable, lambda e: parts(e, "onclick")))
    rows = hits.select(*keep, F.posexplode(found).alias("link_pos", "link")).where(F.col("link.raw").isNotNull())
    rows = rows.select(*keep, "link_pos", F.col("link.source").alias("link_source"),
                       urls.unescape_html("link.raw").alias("raw"), urls.unescape_html("link.text").alias("link_text"),
                       urls.unescape_html("link.title").alias("link_title"))
    return _targets(rows, keep, url, suffix)


def nested_links(pages: DataFrame, url: str = "url", html: str = "html", suffix: str = ".pdf") -> DataFrame:
    """``html_links`` by a stack of open elements: the text of a link is all of it, also that of elements inside it.

    For markup whose links hold others of their kind; ``html_links`` ends a text there and needs no Python.
    """
    keep = [c for c in pages.columns if c != html]
    hits = pages.where(F.contains(F.lower(html), F.lit(suffix.lower()))) if suffix else pages
    rows = hits.select(*keep, F.posexplode(markup.links_of(html)).alias("link_pos", "link")).select(
        *keep, "link_pos", F.col("link.source").alias("link_source"), F.col("link.raw").alias("raw"),
        F.col("link.text").alias("link_text"), F.col("link.title").alias("link_title"))
    return _targets(rows, keep, url, suffix)


def _targets(rows: DataFrame, keep: Sequence[str], url: str, suffix: str) -> DataFrame:
    """Links whose ``href`` ends in the suffix, or whose ``onclick`` quotes a text that holds it, with their whole URL."""
    wanted = suffix.lower()
    quoted = rf"""["']([^"']*{_literal(suffix)}[^"']*)["']"""
    target = (F.when(F.col("link_source") == "href", F.when(F.lower("raw").endswith(wanted) & (F.col("raw") != ""), F.col("raw")))
              .otherwise(F.nullif(F.regexp_extract("raw", quoted, 1), F.lit(""))))
    return (rows.withColumn("target", target).where(F.col("target").isNotNull())
            .select(*keep, "link_pos", "link_source", urls.resolve_url(url, "target").alias("link_url"),
                    "link_text", "link_title"))


def _literal(text: str) -> str:
    """Escape a suffix for use inside a pattern."""
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in text)


def table_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of the HTML tables: page columns but the HTML, row_pos, cells array<string>."""
    keep = [c for c in pages.columns if c != html]
    clean = urls.visible_html(html)
    rows = F.regexp_extract_all(clean, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?:</tr\s*>|(?=<tr\b)|</table)"), F.lit(1))
    cell = lambda body: strip(F.regexp_replace(F.regexp_replace(body, r"(?i)<br\s*/?>", "\n"), r"(?s)<[^>]*>", ""))
    cells = lambda r: F.transform(
        F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)(?:</td\s*>|(?=<td\b)|$)"), F.lit(1)), cell)
    return pages.select(*keep, F.posexplode(F.transform(rows, cells)).alias("row_pos", "cells"))


def nested_table_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """``table_cells`` by a stack of open elements, for tables in cells and cells and rows without an end tag.

    Page columns but the HTML, table (number as it begins), parent (table it stands in, -1 for none), row_pos, cells. The
    text of a cell is its own, without that of tables inside it.
    """
    keep = [c for c in pages.columns if c != html]
    rows = pages.select(*keep, F.explode(markup.table_rows_of(html)).alias("r"))
    return rows.select(*keep, "r.table", "r.parent", F.col("r.row").alias("row_pos"), "r.cells")


def registry_rows(table: DataFrame, cells: str = "cells", row_pos: str = "row_pos") -> DataFrame:
    """One row per variety named in a portal table row; the header and rows under 5 cells are skipped."""
    keep = [c for c in table.columns if c not in (cells, row_pos)]
    cell = lambda i: F.get(F.col(cells), F.lit(i))
    usable = table.where((F.col(row_pos) > 0) & (F.size(cells) >= 5))
    year = year_cell(cell(2))
    return usable.select(
        *keep, row_pos, strip(cell(0)).alias("sl_no"), strip(cell(1)).alias("crop_name"), year["year"].alias("year"),
        year["variety_count"].alias("variety_count"), strip(cell(3)).alias("state"),
        F.posexplode(split_values(cell(4))).alias("value_pos", "variety_name"))


def parse_replies(replies: DataFrame, text: str = "reply_text") -> DataFrame:
    """Add ``items`` (array<variant>, null when the reply holds no usable array) and ``status`` ok/repaired/failed."""
    clean = replies.withColumn("_text", strip_fences(text))
    whole = F.json_array_length("_text").isNotNull()
    cut_off = ~whole & F.startswith("_text", F.lit("["))
    # Only cut-off arrays carry their text into the repair UDF; the others pass a null.
    ready = (clean.withColumn("_repaired", repair_array(F.when(cut_off, F.col("_text"))))
             .withColumn("_array", F.when(whole, F.col("_text")).otherwise(F.col("_repaired"))))
    items = F.try_parse_json("_array").cast("array<variant>")
    # A generator runs once per row: filters on its columns are not pushed below it, where they would parse again.
    once = ready.select(*replies.columns, F.col("_repaired").isNotNull().alias("_fixed"),
                        F.explode(F.array(items)).alias("items"))
    usable = once.withColumn("items", F.when(F.size("items") > 0, F.col("items")))
    status = (F.when(F.col("items").isNull(), F.lit("failed")).when(F.col("_fixed"), F.lit("repaired"))
              .otherwise(F.lit("ok")))
    return usable.withColumn("status", status).drop("_fixed")


def reply_records(parsed: DataFrame, document: str, run_ts: str, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """Fixed-schema string records, one per JSON object of a reply; other elements and unknown keys are ignored."""
    record = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    as_values = lambda e: F.when(is_json_object(e), F.from_json(F.to_json(e), record))
    rows = parsed.where(F.col("items").isNotNull()).select(
        F.col(document).alias("_document"), F.posexplode(F.transform("items", as_values)).alias("record_pos", "_values"))
    columns = {f: c for f, c in zip(fields, conform(F.col("_values"), fields))}
    columns |= {"source_document_filename": F.col("_document").alias("source_document_filename"),
                "extraction_timestamp": F.lit(run_ts).alias("extraction_timestamp")}
    return rows.where(F.col("_values").isNotNull()).select("record_pos", *columns.values())


def reply_summary(parsed: DataFrame) -> DataFrame:
    """One row of batch totals; the failed documents themselves are ``parsed`` filtered on its status."""
    n = lambda s: F.count_if(F.col("status") == s)
    return parsed.agg(F.count("*").alias("total_documents"), F.count_if(F.col("status") != "failed").alias("successful"),
                      n("repaired").alias("repaired"), n("failed").alias("failed"))
