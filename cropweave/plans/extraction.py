"""Turn reply texts into extraction records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.functions.jsonio import is_json_object
from cropweave.functions.text import document_key
from cropweave.operators.extract import parse_replies, reply_records, reply_summary
from cropweave.session import stage_table
from cropweave.sources.writers import write_json, write_parquet, write_records


def extract_records(replies: DataFrame, run_ts: str, document: str = "doc_path", text: str = "reply_text") -> DataFrame:
    """All records of all replies with the output key of their document.

    The key is read from the first record of a reply, so it needs no second pass over the records.
    """
    return parsed_records(parse_replies(replies, text), run_ts, document)


def parsed_records(parsed: DataFrame, run_ts: str, document: str = "doc_path") -> DataFrame:
    """Records of replies that ``parse_replies`` has read."""
    first = F.get("items", F.lit(0))
    head = F.when(is_json_object(first), F.from_json(F.to_json(first), "meeting_number string, document_date string"))
    stem = F.element_at(F.split(document, "/"), -1)
    today = F.lit(run_ts[:10].replace("-", ""))
    keyed = parsed.withColumn("document_key", document_key(head["meeting_number"], stem, F.coalesce(head["document_date"], today)))
    records = reply_records(keyed.withColumn("_doc", F.struct(stem.alias("name"), "document_key")), "_doc", run_ts)
    return (records.withColumn("document_key", F.col("source_document_filename.document_key"))
            .withColumn("source_document_filename", F.col("source_document_filename.name")))


def run(replies: DataFrame, out: str, run_ts: str) -> DataFrame:
    """Write the records per document, the failed documents and the batch summary; returns the summary."""
    parsed = stage_table(parse_replies(replies).select("doc_path", "items", "status"))
    write_records(parsed_records(parsed, run_ts), f"{out}/records", "document_key")
    status = write_parquet(parsed.select("doc_path", "status"), f"{out}/status")
    write_json(status.where(F.col("status") == "failed"), f"{out}/failed_documents")
    summary = reply_summary(status)
    write_json(summary, f"{out}/batch_summary")
    return summary
