"""Match two variety registries and report on the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.text import first_year, to_number
from cropweave.operators import matching
from cropweave.operators.columns import pick_column, registry_keys
from cropweave.operators.ordering import with_sequential_id
from cropweave.sources.writers import snapshot, write_csv, write_json, write_parquet

LEFT_NAMES, LEFT_CROPS = ("variety_standardized", "crop_variety", "variety_name"), ("crop_standardized", "crop", "crop_type")
INSTITUTIONS = ("breeding_institution", "institution", "institution_name", "sponsoring_institution")
RIGHT_NAMES, RIGHT_CROPS = ("variety_name", "variety", "name"), ("crop_name", "crop", "crop_type")


def prepare_left(df: DataFrame, order: str = "src_pos") -> DataFrame:
    """Approval list with ids (given before rows are dropped, so they may have gaps), keys and year."""
    named = with_sequential_id(df, [order], "csc_raw_id", "CSC_")
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    year = to_number("extracted_year").try_cast("int") if "extracted_year" in df.columns else first_year(texts)
    dated = named.withColumn("year_extracted", year)
    return registry_keys(dated, pick_column(df, LEFT_NAMES, "variety"), pick_column(df, LEFT_CROPS, "crop"))


def prepare_right(df: DataFrame) -> DataFrame:
    return registry_keys(df, pick_column(df, RIGHT_NAMES, "variety"), pick_column(df, RIGHT_CROPS, "crop"))


def match_registries(left: DataFrame, right: DataFrame, run_ts: str, threshold: int = 80,
                     order: str = "src_pos") -> DataFrame:
    """Every approval-list row with its best portal row, confidence, review flags and audit columns.

    Where both registries have an institution column, the records tell whether the two agree.
    """
    mine, theirs = (next((c for c in INSTITUTIONS if c in df.columns), None) for df in (left, right))
    names = ["variety_original", "variety_clean", "crop_original", "crop_clean", order, *([theirs] if theirs else [])]
    rights = prepare_right(right).select(*names)
    matched = matching.best_matches(
        prepare_left(left, order), rights, left_name="variety_clean", left_block="crop_clean",
        right_name="variety_clean", right_block="crop_clean", right_order=[order], threshold=threshold)
    return matching.final_records(matching.match_records(matched, mine, theirs), run_ts)


def run(left: DataFrame, right: DataFrame, out: str, run_ts: str, threshold: int = 80, sample: int = 100) -> DataFrame:
    """Snapshot the inputs, write the matches, the review samples and the report; returns the written matches."""
    snapshot({"left": left, "right": right}, out)
    final = write_parquet(match_registries(left, right, run_ts, threshold), f"{out}/final")
    drawn = matching.review_sample(final, "csc_raw_id", n=sample)
    for status in ("MATCHED", "UNMATCHED"):
        write_csv(drawn.where(F.col("match_status") == status), f"{out}/manual_review/{status.lower()}_sample")
    write_json(matching.match_report(final).withColumn("timestamp", F.lit(run_ts)), f"{out}/reports")
    return final
