"""The one-row catalogue summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.functions.jsonio import array_size
from cropweave.operators.counts import diversity, element_counts, top_k, value_counts

# Standard columns of a published catalogue; pass another mapping for other names.
CATALOGUE = {
    "crop": "crop_type", "institution": "breeding_institution", "score": "data_completeness_score",
    "traits": "stressors_tolerated", "year": "year_of_release", "states": "recommended_states",
    "quality": "quality_flag", "confidence": "confidence_level",
}


def _leader(counts: DataFrame, value: str) -> Column:
    """Top row of a count table as a struct (name, count); null when the table is empty."""
    return top_k(counts, 1).select(F.struct(F.col(value).alias("name"), "count")).scalar()


def totals(c: dict[str, str]) -> list[Column]:
    """Aggregates of the summary that need nothing but one pass; ``c`` names the columns."""
    n, size, year = F.count("*"), array_size(c["traits"]), F.col(c["year"])
    share = lambda condition: F.try_divide(F.count_if(condition) * 100.0, n)
    return [
        n.alias("total_varieties"), F.avg(c["score"]).alias("mean_completeness"),
        F.count_if(size > 0).alias("with_traits"), share(size > 0).alias("with_traits_percent"),
        F.count_if(size >= 3).alias("multi_trait_count"),
        F.count_if(year >= 2010).alias("recent_count"),
        F.avg(F.when(year >= 1990, year)).alias("mean_year_since_1990"),
        share(F.upper(c["quality"]) == "GOOD").alias("good_quality_percent"),
        share(F.upper(c["confidence"]) == "HIGH").alias("high_confidence_percent"),
        F.count_if(F.col(c["score"]) < 0.5).alias("low_completeness_count")]


def summary_kpis(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Totals, distinct counts, leaders, shares and recency in one row."""
    c = {**CATALOGUE, **(columns or {})}
    row = df.agg(*totals(c), *[F.count_distinct(F.col(c[k])).alias(f"{k}|distinct") for k in ("crop", "institution")])
    return summary(row, {
        "crop": value_counts(df, c["crop"], "name"), "institution": value_counts(df, c["institution"], "name"),
        "diverse_institution": diversity(df, c["institution"], c["crop"]).withColumnRenamed(c["institution"], "name"),
        "trait": element_counts(df, c["traits"], "name"), "state": element_counts(df, c["states"], "name")})


def summary(row: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """The summary from its one-row aggregate and the count tables (name, count) of its leaders."""
    crops, n = F.col("`crop|distinct`"), F.col("total_varieties")
    base = row.select(
        "total_varieties", crops.alias("unique_crops"), F.col("`institution|distinct`").alias("unique_institutions"),
        "mean_completeness", F.try_divide(crops, n).alias("crop_diversity_index"), "with_traits", "with_traits_percent",
        "multi_trait_count", "recent_count", "mean_year_since_1990", "good_quality_percent", "high_confidence_percent",
        "low_completeness_count")
    leaders = {name: _leader(counts, "name") for name, counts in tables.items()}
    columns_of = [col for name, top in leaders.items()
                  for col in (top["name"].alias(f"top_{name}"), top["count"].alias(f"top_{name}_count"))]
    return base.select("*", *columns_of, tables["state"].agg(F.count("*")).scalar().alias("unique_states"))
