"""Compile research context and attach it, with the analysis, to varieties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.jsonio import parse_object
from cropweave.operators import context as ctx
from cropweave.session import stage_table
from cropweave.sources.writers import write_json, write_parquet

RESULT_FIELDS = ("title", "author", "year", "journal", "abstract", "url", "snippet", "citations")

_TEXT = T.StringType()


def _texts(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TEXT) for n in names.split()])


_LEVEL = T.StructType([
    T.StructField("tolerance_level", _TEXT), T.StructField("mechanisms", _TEXT), T.StructField("qtl_information", _TEXT),
    T.StructField("evidence_sources", T.ArrayType(_TEXT)), T.StructField("technical_details", _TEXT)])
_STRESS = T.StructType([
    *[T.StructField(n, _LEVEL) for n in ("drought_tolerance", "heat_tolerance", "salinity_tolerance", "flood_tolerance",
                                         "submergence_tolerance", "disease_resistance", "pest_resistance")],
    T.StructField("overall_stress_tolerance", _TEXT), T.StructField("key_stress_attributes", T.ArrayType(_TEXT))])
_EVIDENCE = T.StructType([
    T.StructField("total_sources", T.IntegerType()), T.StructField("peer_reviewed_sources", T.IntegerType()),
    T.StructField("government_sources", T.IntegerType()), T.StructField("reliability_score", T.DoubleType()),
    T.StructField("overall_evidence_quality", _TEXT), T.StructField("evidence_gaps", _TEXT)])

# The shape of an analysis reply.
ANALYSIS_SCHEMA = T.StructType([
    T.StructField("variety_analysis", _texts("variety_name crop_type overall_assessment")),
    T.StructField("variety_identification", _texts("variety_name crop_type overall_assessment")),
    T.StructField("stress_tolerance_profile", _STRESS),
    T.StructField("genetic_and_molecular_profile",
                  _texts("qtl_mapping molecular_markers genetic_markers genomic_data gene_sequences")),
    T.StructField("agronomic_performance",
                  _texts("yield_data maturity_days growth_characteristics environmental_adaptation input_requirements")),
    T.StructField("research_and_development",
                  _texts("development_institution breeder_information breeding_program testing_locations development_timeline")),
    T.StructField("commercial_availability",
                  _texts("seed_availability distribution_networks kvk_availability farmer_adoption")),
    T.StructField("evidence_quality_assessment", _EVIDENCE),
    T.StructField("comprehensive_summary", _TEXT),
    T.StructField("reference_links", T.ArrayType(_TEXT)),
    T.StructField("post_2008_content_percentage", T.DoubleType()),
])


def compile_context(varieties: DataFrame, results: DataFrame, run_ts: str,
                    fields: Sequence[str] = RESULT_FIELDS) -> DataFrame:
    """Context documents of varieties (variety_name, crop_name) from a table of search results.

    ``results`` holds one row per hit (variety_name, query, type, result_pos, success, error, and the result fields);
    a failed query has one row with success = false. Queries are the generated ones, so a document has at most 30
    entries of at most 10 results. A query without any row counts as failed, not executed.
    """
    key = ["variety_name", "query", "type"]
    names = varieties.select("variety_name", "crop_name").distinct()
    queries = ctx.search_queries(names).drop("post_2008", "priority")
    outcome = results.groupBy(*key).agg(F.bool_or("success").alias("success"), F.max("error").alias("error"))
    executed = (queries.join(outcome, on=key, how="left")
                .withColumn("error", F.when(F.col("success").isNull(), F.lit("not executed")).otherwise(F.col("error")))
                .withColumn("success", F.coalesce("success", F.lit(False))))
    hits = results.where(F.col("success") & F.col("title").isNotNull())
    kept = ctx.keep_recent(ctx.ranked_results(hits, key, ["result_pos"]))
    full = ctx.query_results(executed, kept, key, fields)
    return ctx.compile_context(full, ["variety_name", "crop_name"], run_ts)


def enrich(varieties: DataFrame, contexts: DataFrame, replies: DataFrame, run_ts: str,
           context_order: Sequence[str] = ("source_path",), model: str = "unspecified",
           version: str = "1.0") -> DataFrame:
    """Nested enriched records: variety, its context and the parsed analysis reply (or its error)."""
    named = contexts.withColumn("_name", F.col("variety_info.variety_name"))
    found = ctx.attach_context(varieties, named, "variety_name", "_name", context_order)
    results = F.col("context.search_results")
    metadata = F.struct(
        F.lit(run_ts).alias("analysis_timestamp"), F.lit(model).alias("gemini_model"),
        F.size(results).alias("total_search_queries"),
        F.size(F.filter(results, lambda r: r["error"].isNull())).alias("successful_queries"),
        F.lit(version).alias("processing_version"))
    # one reply a name: the last in the order of their texts, so two replies do not double a record
    one = replies.groupBy("variety_name").agg(F.max("reply_text").alias("reply_text"))
    analysed = found.join(one, on="variety_name", how="left")
    parsed = analysed.withColumn("_parsed", parse_object("reply_text", ANALYSIS_SCHEMA))
    fields = [F.col(f"_parsed.value.{f}").alias(f) for f in ANALYSIS_SCHEMA.fieldNames()]
    return parsed.select(
        F.struct(*varieties.columns).alias("original_data"),
        F.col("context").dropFields("_name").alias("context_data"),
        F.struct(*fields, metadata.alias("processing_metadata"), F.col("_parsed.error").alias("error")).alias("analysis_result"),
        F.lit(run_ts).alias("enrichment_timestamp"))


def run_context(varieties: DataFrame, results: DataFrame, out: str, run_ts: str, batch: int,
                fields: Sequence[str] = RESULT_FIELDS) -> DataFrame:
    """Add the context documents of a batch and rewrite its counters; returns all documents of the batch.

    Varieties whose names stand in the manifest of finished names (``out/finished``) are skipped, and so are those with
    a document in this batch, should an earlier run have ended before its manifest entry. A batch only grows.
    """
    spark, folder, finished = varieties.sparkSession, f"{out}/contexts", f"{out}/finished"
    spark.createDataFrame([], "variety_name string").write.mode("append").parquet(finished)
    done = spark.read.schema("variety_name string").parquet(finished)
    shape = compile_context(varieties.limit(0), results.limit(0), run_ts, fields).withColumn("batch", F.lit(batch))
    shape.limit(0).write.mode("append").partitionBy("batch").json(folder)
    there = spark.read.schema(shape.schema).json(folder).where(F.col("batch") == batch)
    fresh = stage_table(ctx.not_yet_done(varieties, done.unionByName(there.select("variety_info.variety_name")), ["variety_name"]))
    documents = compile_context(fresh, results, run_ts, fields).withColumn("batch", F.lit(batch))
    documents.write.mode("append").partitionBy("batch").json(folder)
    fresh.select("variety_name").distinct().write.mode("append").parquet(finished)
    written = spark.read.schema(shape.schema).json(folder).where(F.col("batch") == batch)
    entries = written.select("variety_info.variety_name", F.explode("search_results").alias("e")).select("variety_name", "e.*")
    write_json(ctx.run_counters(entries, ["variety_name"]).withColumn("batch", F.lit(batch)), f"{out}/counters/batch={batch}")
    return written


def run_enrichment(varieties: DataFrame, contexts: DataFrame, replies: DataFrame, out: str, run_ts: str,
                   batch: int = 1) -> DataFrame:
    """Write the enriched records of a batch and the varieties that have no context."""
    missing = ctx.without_context(varieties, contexts.withColumn("_name", F.col("variety_info.variety_name")),
                                  "variety_name", "_name")
    write_json(missing, f"{out}/without_context/batch={batch}")
    return write_parquet(enrich(varieties, contexts, replies, run_ts), f"{out}/enriched/batch={batch}")
