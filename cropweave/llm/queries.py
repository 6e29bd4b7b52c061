"""The queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cropweave.llm import (alignment, audit, decontaminate, html, line_dedup, near_dup, packing, perplexity, phrases, secrets,
                           storage, toxicity, warc, wavelet)
from cropweave.llm.base import query, table


@query("op4_minhash_near_dup", near_dup.SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@query("op2_winnow_decontaminate", decontaminate.SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("row")


@query("op3_winnow_line_dedup", line_dedup.SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduplicate_lines(table(spark, folder, "documents"))


@query("op10_segment_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_kneser_ney_quality")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.quality(table(spark, folder, "documents"))


@query("op7_entropy_secrets", secrets.SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query("op1_bm25_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op9_wavelet_shards")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    catalogue = wavelet.write_shards(table(spark, folder, "documents"), storage.new_folder(spark, "tokens"))
    return wavelet.read_documents(catalogue)


@query("op5_wacz_records", warc.SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    catalogue = warc.write_packages(table(spark, folder, "pages"), storage.new_folder(spark, "archives"))
    return warc.read_records(warc.read_index(catalogue)).drop("url", "payload")


@query("op8_suffix_array_html")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


@query("op11_lz_fingerprint")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.edited_pairs(table(spark, folder, "documents"))


@query("op12_filter_tensor_audit", audit.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(table(spark, folder, "documents"))
