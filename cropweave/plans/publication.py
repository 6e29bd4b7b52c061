"""Turn enriched records into the published catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.functions.jsonio import path_column
from cropweave.functions.text import UNKNOWN, name_features, strip, title_case
from cropweave.operators import duplicates, search
from cropweave.operators.columns import missing_paths, project_paths, resolves, trim_strings
from cropweave.operators.ordering import with_position, with_sequential_id
from cropweave.operators.quality import orphans
from cropweave.operators.stats import column_profile
from cropweave.session import stage_table
from cropweave.sources import versions
from cropweave.sources.writers import schema_document, write_csv, write_json, write_parquet

ANALYSIS = ("analysis_result.variety_analysis.variety_name", "analysis_result.variety_identification.variety_name")
_STRESS = "analysis_result.stress_tolerance_profile"

# Published column, where it comes from, what it means.
PUBLISHED: tuple[tuple[str, str, str], ...] = (
    ("variety_name", "original_data.variety_name", "Standardized variety name"),
    ("crop_type", "original_data.crop_type", "Type of crop"),
    ("approval_status", "original_data.approval_status", "Regulatory approval status"),
    ("stress_tolerance_drought", f"{_STRESS}.drought_tolerance.tolerance_level",
     "Drought tolerance level (high/medium/low/unknown)"),
    ("stress_tolerance_heat", f"{_STRESS}.heat_tolerance.tolerance_level", "Heat tolerance level"),
    ("stress_tolerance_salinity", f"{_STRESS}.salinity_tolerance.tolerance_level", "Salinity tolerance level"),
    ("stress_tolerance_flood", f"{_STRESS}.flood_tolerance.tolerance_level", "Flood tolerance level"),
    ("stress_tolerance_disease", f"{_STRESS}.disease_resistance.tolerance_level", "Disease resistance level"),
    ("stress_tolerance_pest", f"{_STRESS}.pest_resistance.tolerance_level", "Pest resistance level"),
    ("genetic_markers", "analysis_result.genetic_and_molecular_profile.molecular_markers", "Available genetic markers"),
    ("qtl_information", "analysis_result.genetic_and_molecular_profile.qtl_mapping", "QTL mapping information"),
    ("yield_potential", "analysis_result.agronomic_performance.yield_data", "Yield performance data"),
    ("maturity_days", "analysis_result.agronomic_performance.maturity_days", "Days to maturity"),
    ("development_institution", "analysis_result.research_and_development.development_institution", "Breeding institution"),
    ("principal_breeder", "analysis_result.research_and_development.breeder_information", "Principal breeder/scientist"),
    ("testing_locations", "analysis_result.research_and_development.testing_locations", "Trial locations"),
    ("commercial_availability", "analysis_result.commercial_availability.seed_availability",
     "Commercial availability status"),
    ("evidence_quality_score", "analysis_result.evidence_quality_assessment.reliability_score",
     "Evidence quality score (1-10)"),
    ("peer_reviewed_sources", "analysis_result.evidence_quality_assessment.peer_reviewed_sources",
     "Number of peer-reviewed sources"),
    ("total_sources", "analysis_result.evidence_quality_assessment.total_sources", "Total number of sources"),
    ("processing_timestamp", "enrichment_timestamp", "Data processing timestamp"),
)
STRESS_TYPES = ("drought_tolerance", "heat_tolerance", "salinity_tolerance", "flood_tolerance", "submergence_tolerance",
                "disease_resistance", "pest_resistance")
KEY_FIELDS = ("variety_name", "crop_type", "approval_status")


# The columns that identify a variety.
ESSENTIAL = ("original_data.variety_name", "original_data.crop_type", "original_data.approval_status",
             "analysis_result.variety_identification.variety_name")


def _name_path(df: DataFrame) -> str:
    return next((p for p in (*ANALYSIS, "original_data.variety_name") if resolves(df, p)), "original_data.variety_name")


def classify(enriched: DataFrame, position: str, features_from: str = "raw") -> DataFrame:
    """Add name features and the duplicate category of every record.

    Features are read from the raw name; ``features_from='titled'`` reads them after title-casing, which hides
    upper-case prefixes. Records without a grouping name are unique.
    """
    name = path_column(_name_path(enriched).split("."))
    shown = title_case(strip(name)) if features_from == "titled" else strip(name)
    standard = "original_data.variety_standardized"
    group = path_column(standard.split(".")) if resolves(enriched, standard) else title_case(strip(name))
    featured = (enriched.withColumn("variety_features", name_features(shown))
                .withColumn("_group", group).withColumn("_prefix", F.col("variety_features.prefix"))
                .withColumn("_number", F.col("variety_features.numeric_id")))
    return duplicates.analyze_duplicates(featured, "_group", "_prefix", "_number", position).drop(
        "_group", "_prefix", "_number")


def publish_schema(consolidated: DataFrame, order: Sequence[str]) -> DataFrame:
    """The 22 published columns, id first, in record order."""
    mapping = {name: path for name, path, _ in PUBLISHED}
    flat = trim_strings(project_paths(consolidated, mapping, keep=[c for c in order if c not in mapping]))
    for field in KEY_FIELDS:
        text = F.col(field).cast("string")
        styled = text if field == "approval_status" else title_case(text)
        flat = flat.withColumn(field, F.coalesce(styled, F.lit(UNKNOWN)))
    numbered = with_sequential_id(flat, list(order), "variety_id", "STS_")
    return numbered.select("variety_id", *mapping)


def build_catalogue(enriched: DataFrame, position: str = "src_pos", features_from: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(published catalogue, duplicate totals) from enriched records with a unique position column."""
    analyzed = stage_table(classify(enriched, position, features_from))
    published = publish_schema(duplicates.consolidate(analyzed, position), [position])
    return published, duplicates.duplicate_totals(analyzed)


def synthesis_summary(input_files: DataFrame, initial: DataFrame, final: DataFrame, totals: DataFrame,
                      run_ts: str, version: str = "1.0") -> DataFrame:
    """One row: input files, rows before and after, rows per duplicate category, run metadata."""
    per_category = totals.agg(F.map_from_entries(F.collect_list(F.struct("category", "rows"))))
    return initial.agg(F.count("*").alias("initial_row_count")).select(
        F.lit(run_ts).alias("timestamp"),
        input_files.agg(F.count_distinct("source_path")).scalar().alias("input_files"), "initial_row_count",
        final.agg(F.count("*")).scalar().alias("final_row_count"),
        per_category.scalar().alias("duplicate_analysis"), F.lit(version).alias("processing_version"))


def run(enriched: DataFrame, out: str, run_ts: str, position: str = "src_pos", features_from: str = "raw") -> DataFrame:
    """Profile, classify, consolidate, publish and report; each stage is written once and read back."""
    write_csv(column_profile(enriched), f"{out}/initial_data_profile")
    lacking = [(path,) for path in missing_paths(enriched, ESSENTIAL)]
    write_json(enriched.sparkSession.createDataFrame(lacking, "missing_column string"), f"{out}/missing_columns")
    analyzed = write_parquet(classify(enriched, position, features_from), f"{out}/classified")
    totals = duplicates.duplicate_totals(analyzed)
    write_json(totals, f"{out}/duplicates_analysis")
    final = publish_schema(duplicates.consolidate(analyzed, position), [position])
    published = write_parquet(final, f"{out}/catalogue")
    write_csv(published, f"{out}/catalogue_csv")
    comments = {"variety_id": "Unique identifier for each variety", **{n: text for n, _, text in PUBLISHED}}
    write_json(schema_document(published, comments), f"{out}/database_schema")
    files = enriched if "source_path" in enriched.columns else enriched.withColumn("source_path", F.input_file_name())
    write_json(synthesis_summary(files, analyzed, published, totals, run_ts), f"{out}/summary_report")
    return published


#: Published columns that searches look up and filter on.
SEARCHED = {"crop": "crop_type", "institution": "development_institution"}


def publish(enriched: DataFrame, root: str, run_ts: str, position: str = "src_pos", features_from: str = "raw") -> dict:
    """``run`` into a version of its own, with the tolerance details and the search index; returns the commit.

    Readers see all of it or, if the run ends half-way, all of the version before (``versions.read_version``).
    """
    def write(folder: str) -> None:
        published = run(enriched, folder, run_ts, position, features_from)
        search.write_index(published, f"{folder}/search_index", "variety_id", SEARCHED, SEARCHED)
        write_parquet(tolerance_details(enriched, position), f"{folder}/details")

    return versions.publish(root, run_ts, write)


def tolerance_details(enriched: DataFrame, variety_id: str, profile: str = "analysis_result.stress_tolerance_profile",
                      confidence: str | None = None) -> DataFrame:
    """Child table: one row per variety and stress type with a known level."""
    entry = lambda kind: F.struct(
        F.lit(kind).alias("stress_type"), path_column([*profile.split("."), kind, "tolerance_level"]).alias("tolerance_level"),
        F.array_join(path_column([*profile.split("."), kind, "evidence_sources"]), "; ").alias("evidence_source"))
    score = path_column(confidence.split(".")).cast("double") if confidence else F.lit(None).cast("double")
    rows = enriched.select(F.col(variety_id).alias("variety_id"), score.alias("confidence_score"),
                           F.explode(F.array(*[entry(k) for k in STRESS_TYPES])).alias("e"))
    return rows.where(F.col("e.tolerance_level").isNotNull()).select(
        "variety_id", "e.stress_type", "e.tolerance_level", "e.evidence_source", "confidence_score")


def export_tables(parents: DataFrame, details: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """Write the parent and the child table; children get their own id and must have a parent.

    Orphans are written aside, not dropped silently.
    """
    kept = details.join(parents.select("variety_id"), "variety_id", "left_semi")
    numbered = with_position(kept, ["variety_id", "stress_type"], "tolerance_id")
    columns = ("tolerance_id", "variety_id", "stress_type", "tolerance_level", "evidence_source", "confidence_score")
    child = numbered.withColumn("tolerance_id", F.col("tolerance_id") + 1).select(*columns)
    write_parquet(orphans(details, parents, "variety_id"), f"{out}/orphans")
    return write_parquet(parents, f"{out}/varieties"), write_parquet(child, f"{out}/tolerance_details")


def nested_json(parents: DataFrame, details: DataFrame, key: str = "variety_id") -> DataFrame:
    """One JSON text per variety, its tolerance details as an object keyed by stress type.

    A variety has one detail row per stress type at most, so the collected map is small.
    """
    entry = F.struct(F.col("stress_type"), F.struct(F.col("tolerance_level").alias("level"),
                                                    F.col("evidence_source").alias("evidence"),
                                                    F.col("confidence_score").alias("confidence")))
    maps = details.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stress_tolerance_details"))
    joined = parents.join(maps, key, "left")
    return joined.select(key, F.to_json(F.struct(*parents.columns, "stress_tolerance_details")).alias("document"))
