"""Completeness, confidence, rules, catalogue search and cross-source checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.jsonio import array_size
from cropweave.functions.labels import banded
from cropweave.functions.text import UNKNOWN, as_col, strip
from cropweave.operators.columns import NOT_SPECIFIED

# Scored fields and their weights in percent.
FIELD_GROUPS: dict[str, tuple[int, tuple[str, ...]]] = {
    "essential": (50, ("variety_name", "crop_type", "year_of_release", "breeding_institution", "recommended_states")),
    "stress": (30, ("stressors_tolerated", "stress_tolerance_level", "drought_tolerance", "disease_resistance")),
    "quality": (20, ("quality_traits", "yield_performance", "maturity_days", "special_features")),
}
COMPONENT_WEIGHTS = {"completeness": 40, "source_reliability": 30, "cross_validation": 20, "expert_verification": 10}
YEAR_RANGE, MATURITY_RANGE = (1968, 2025), (60, 200)
YIELD_UNITS = ("q/ha", "t/ha", "kg/ha")
STRESS_CATEGORIES = ("Drought", "Heat", "Cold", "Salinity", "Waterlogging")
CROP_CATEGORIES = ("Cereals", "Pulses", "Oilseeds", "Vegetables", "Spices")


def is_filled(df: DataFrame, column: str) -> Column:
    """Not null, not blank, no missing-value marker, no empty array; false for a column the frame lacks."""
    if column not in df.columns:
        return F.lit(False)
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return array_size(column) > 0
    text = strip(F.col(column).cast("string"))
    return F.coalesce(~text.isin("", NOT_SPECIFIED, UNKNOWN, "[]"), F.lit(False))


def completeness_score(df: DataFrame, groups: Mapping[str, tuple[int, Sequence[str]]] = FIELD_GROUPS) -> Column:
    """Weighted share of filled fields, 0-1."""
    parts = []
    for weight, fields in groups.values():
        filled = sum((is_filled(df, f).cast("int") for f in fields), F.lit(0))
        parts.append(filled * F.lit(weight / 100.0) / len(fields))
    return sum(parts[1:], parts[0])


def composite_quality(components: Mapping[str, Column | str], weights: Mapping[str, int] = COMPONENT_WEIGHTS) -> Column:
    """Weighted quality from component scores in 0-1; a missing component counts 0."""
    parts = [F.coalesce(as_col(components[k]), F.lit(0.0)) * F.lit(w / 100.0) if k in components else F.lit(0.0)
             for k, w in weights.items()]
    return sum(parts[1:], parts[0])


def confidence_level(score: Column | str, sources: Column | str, verified: Column | str) -> Column:
    """HIGH: 90 % complete, several sources, verified. MEDIUM: 70 % and two sources. LOW otherwise."""
    s, n = as_col(score), as_col(sources)
    high = (s >= 0.9) & (n >= 2) & F.coalesce(as_col(verified), F.lit(False))
    return F.when(high, F.lit("HIGH")).when((s >= 0.7) & (n >= 2), F.lit("MEDIUM")).otherwise(F.lit("LOW"))


def quality_flag(score: Column | str, excellent: float | None = None, good: float = 0.8, moderate: float = 0.5) -> Column:
    bands = [(excellent, "EXCELLENT")] if excellent is not None else []
    return banded(as_col(score), [*bands, (good, "GOOD"), (moderate, "MODERATE")], "POOR")


def standard_rules(year: str | None = None, maturity: str | None = None, yield_unit: str | None = None,
                   stresses: str | None = None, crop_category: str | None = None) -> dict[str, Column]:
    """Rule name -> condition for the columns given. A null value passes; it is a completeness matter."""
    rules: dict[str, Column] = {}
    if year:
        rules["year_range"] = F.col(year).between(*YEAR_RANGE)
    if maturity:
        rules["maturity_range"] = F.col(maturity).between(*MATURITY_RANGE)
    if yield_unit:
        rules["yield_units"] = F.lower(yield_unit).isin(*YIELD_UNITS)
    if stresses:
        allowed = [s.lower() for s in STRESS_CATEGORIES]
        rules["stress_categories"] = F.forall(F.col(stresses), lambda s: F.lower(s).isin(*allowed))
    if crop_category:
        rules["crop_categories"] = F.lower(crop_category).isin(*[c.lower() for c in CROP_CATEGORIES])
    return rules


def rule_violations(rules: Mapping[str, Column]) -> Column:
    """Names of the failed rules, in the order given."""
    failed = F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()])
    return F.array_compact(failed)


def search_catalogue(df: DataFrame, *, crop: str | None = None, state: str | None = None,
                     stressors: Sequence[str] = (), institution: str | None = None, min_score: float | None = None,
                     flags: Sequence[str] = (), columns: Mapping[str, str] | None = None) -> DataFrame:
    """Catalogue filter; every given condition must hold. Scalar conditions reach the file scan."""
    names = {"crop": "crop_type", "state": "recommended_states", "stressors": "stressors_tolerated",
             "institution": "breeding_institution", "score": "data_completeness_score", "flag": "quality_flag",
             **(columns or {})}
    if crop is not None:
        df = df.where(F.col(names["crop"]) == crop)
    if institution is not None:
        df = df.where(F.col(names["institution"]) == institution)
    if min_score is not None:
        df = df.where(F.col(names["score"]) >= min_score)
    if flags:
        df = df.where(F.upper(names["flag"]).isin(*[f.upper() for f in flags]))
    if state is not None:
        df = df.where(F.array_contains(names["state"], state))
    if stressors:
        df = df.where(F.arrays_overlap(F.col(names["stressors"]), F.array(*[F.lit(s) for s in stressors])))
    return df


def consistency_check(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Full outer comparison of two sources: where each key is found and whether each field agrees.

    A null key equals no other, so such a row is found on its own side only.
    """
    left, right = a.withColumn("_left", F.lit(True)).alias("a"), b.withColumn("_right", F.lit(True)).alias("b")
    joined = left.join(right, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    presence = (F.when(F.col("_right").isNull(), F.lit("left_only"))
                .when(F.col("_left").isNull(), F.lit("right_only")).otherwise(F.lit("both")))
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), presence.alias("presence"),
                         *[F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")).alias(f"{f}_agrees") for f in fields])


def reconcile(sources: Mapping[str, DataFrame], key: str, fields: Sequence[str]) -> DataFrame:
    """Compare any number of sources by key in one aggregate of their stacked rows.

    Per key: ``found_in`` and ``missing_in`` (names in the order given), ``repeated_in`` (sources with several rows of the
    key, of which the smallest value of a field counts), and for every field ``<field>_agrees`` and ``<field>_differs_in``,
    the first source that has the key and another value than the first one that has it; null equals null only. A null key
    equals none of another source: every source has a row of its own for its null keys. Rows are combined before the
    shuffle, so a key with a third of all rows makes no large group.
    """
    names = list(sources)
    stacked = reduce(DataFrame.unionByName, [
        df.select(F.col(key).alias("_key"), F.lit(i).alias("_source"), *[F.col(f).alias(f"_{f}") for f in fields])
        for i, df in enumerate(sources.values())])
    own = lambda i, c: F.when(F.col("_source") == i, c)
    grouped = stacked.groupBy("_key", F.when(F.col("_key").isNull(), F.col("_source")).alias("_lost")).agg(
        *[F.count(own(i, F.lit(1))).alias(f"n{i}") for i in range(len(names))],
        *[F.min(own(i, F.struct(F.col(f"_{f}").alias("v")))).alias(f"{f}|{i}") for f in fields for i in range(len(names))])

    def which(condition: Callable[[int], Column]) -> Column:
        return F.array_compact(F.array(*[F.when(condition(i), F.lit(n)) for i, n in enumerate(names)]))

    def compared(field: str) -> list[Column]:
        value = [F.col(f"`{field}|{i}`") for i in range(len(names))]
        first = F.coalesce(*value)
        other = F.coalesce(*[F.when(v.isNotNull() & ~v["v"].eqNullSafe(first["v"]), F.lit(n)) for v, n in zip(value, names)])
        return [other.isNull().alias(f"{field}_agrees"), other.alias(f"{field}_differs_in")]

    return grouped.select(
        F.col("_key").alias(key), which(lambda i: F.col(f"n{i}") > 0).alias("found_in"), which(lambda i: F.col(f"n{i}") == 0).alias("missing_in"),
        which(lambda i: F.col(f"n{i}") > 1).alias("repeated_in"), *[c for f in fields for c in compared(f)])


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent lacks."""
    return child.join(parent.select(key), on=key, how="left_anti")
