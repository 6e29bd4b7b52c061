"""Rule-based duplicate analysis and consolidation.

All group tests come from two stacked aggregates, so a group holding a third of the rows is combined on the map
side and never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.operators.ordering import with_position

UNIQUE, EXACT, RELATED, TYPO = "Unique", "Exact Match", "Related but Distinct", "Typo/Formatting Issue"
COLLAPSED = (EXACT, TYPO)


def duplicate_groups(df: DataFrame, key: str, prefix: str, numeric: str, position: str) -> DataFrame:
    """One row per key that occurs more than once: category, match id, first position, size.

    Every (prefix, number) repeated -> exact; one prefix, several numbers -> related; else typo.
    """
    variants = (df.where(F.col(key).isNotNull())
                .select(F.col(key).alias("group_key"), F.col(prefix).alias("prefix"), F.col(numeric).alias("number"),
                        F.col(position).alias("position"))
                .groupBy("group_key", "prefix", "number")
                .agg(F.count("*").alias("rows"), F.min("position").alias("first")))

    def values(c: str) -> Column:
        """1 or 2 for one or several values; a null is a value."""
        several = (F.min(c) < F.max(c)) | (F.count(c).between(1, F.count("*") - 1))
        return F.when(several, 2).otherwise(1)

    groups = (variants.groupBy("group_key")
              .agg(F.sum("rows").alias("group_size"), F.min("rows").alias("fewest"), F.min("first").alias("first_position"),
                   (values("prefix") == 1).alias("one_prefix"),
                   (values("number") > 1).alias("many_numbers"))
              .where(F.col("group_size") > 1))
    category = (F.when(F.col("fewest") >= 2, F.lit(EXACT))
                .when(F.col("one_prefix") & F.col("many_numbers"), F.lit(RELATED)).otherwise(F.lit(TYPO)))
    ranked = with_position(groups, ["group_key"], "match_id")
    return ranked.select("group_key", "match_id", category.alias("category"), "first_position", "group_size")


def analyze_duplicates(df: DataFrame, key: str, prefix: str, numeric: str, position: str) -> DataFrame:
    """Add ``duplicate_category``, ``duplicate_match_id`` (-1 when unique) and ``duplicate_first``."""
    groups = duplicate_groups(df, key, prefix, numeric, position)
    joined = df.alias("a").join(groups.alias("g"), F.col(f"a.{key}") == F.col("g.group_key"), "left")
    return joined.select("a.*", F.coalesce("g.category", F.lit(UNIQUE)).alias("duplicate_category"),
                         F.coalesce("g.match_id", F.lit(-1)).alias("duplicate_match_id"),
                         F.coalesce("g.first_position", f"a.{position}").alias("duplicate_first"))


def duplicate_totals(analyzed: DataFrame) -> DataFrame:
    return analyzed.groupBy(F.col("duplicate_category").alias("category")).agg(F.count("*").alias("rows"))


def consolidate(analyzed: DataFrame, position: str) -> DataFrame:
    """Keep the first row of exact and typo groups and every other row."""
    keep = ~F.col("duplicate_category").isin(*COLLAPSED) | (F.col(position) == F.col("duplicate_first"))
    return analyzed.where(keep)
