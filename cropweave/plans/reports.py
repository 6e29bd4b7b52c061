"""The standard set of catalogue reports, from few scans of the catalogue.

Most reports count something. Each row becomes a short list of facts (kind, a, b, x), such as (value, crop_type, RICE) or
(cross, Drought, RICE), which one scan counts before anything is shuffled; the counts are stored and every report reads
its kinds of them. What is no count (sums, correlations, shares) is one aggregate of a second scan. The two reports that
list rows filter the catalogue itself. So the catalogue is scanned at most four times for all reports.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.functions.jsonio import array_size
from cropweave.functions.text import decade
from cropweave.operators import counts, kpis, stats
from cropweave.operators.ordering import counted_quantiles
from cropweave.session import stage_table

#: Columns whose values are counted, arrays whose elements and sizes are counted.
VALUES = ("variety_name", "crop_type", "breeding_institution", "quality_flag", "confidence_level", "year_of_release")
ELEMENTS = ("stressors_tolerated", "recommended_states", "quality_traits")
SIZES = ("stressors_tolerated", "quality_traits")
SCORE, RECENT = "data_completeness_score", 2010


def multi_trait(df: DataFrame, at_least: int = 3, traits: str = "stressors_tolerated") -> DataFrame:
    """Varieties with several traits, the traits joined to a text."""
    return df.where(array_size(traits) >= at_least).select("variety_name", "crop_type",
                                                           F.array_join(traits, ", ").alias("traits"))


def usual_range(df: DataFrame) -> DataFrame:
    """Maturity against year without outliers."""
    return df.where((F.col("maturity_days") < 300) & (F.col("year_of_release") > 1990))


def _fact(kind: str, a: Column, b: Column | None = None, x: Column | None = None, v: Column | None = None) -> Column:
    nothing = lambda kind: F.lit(None).cast(kind)
    return F.struct(F.lit(kind).alias("kind"), a.cast("string").alias("a"),
                    (nothing("string") if b is None else b.cast("string")).alias("b"),
                    (nothing("double") if x is None else x.cast("double")).alias("x"),
                    (nothing("double") if v is None else v.cast("double")).alias("v"))


def facts(df: DataFrame) -> dict[str, Column]:
    """For each kind of facts, the array of a row's facts; absent ones are null."""
    crop, owner, score = F.col("crop_type"), F.col("breeding_institution"), F.col(SCORE)
    given = lambda c, fact: F.when(F.col(c).isNotNull(), fact)
    each = lambda array, fact: F.transform(F.coalesce(array, F.array().cast("array<string>")),
                                           lambda e: F.when(e.isNotNull(), fact(e)))
    return {
        "value": F.array(*[given(c, _fact("value", F.lit(c), F.col(c))) for c in VALUES]),
        "number": F.array(*[given(c, _fact("number", F.lit(c), x=F.col(c))) for c in stats.numeric_columns(df)]),
        "element": F.concat(*[each(F.col(c), lambda e, c=c: _fact("element", F.lit(c), e)) for c in ELEMENTS]),
        "size": F.array(*[_fact("size", F.lit(c), x=array_size(c)) for c in SIZES]),
        "cross": F.when(crop.isNotNull(), each(F.col("stressors_tolerated"), lambda e: _fact("cross", e, crop))),
        "recent": F.array(F.when(crop.isNotNull() & (F.col("year_of_release") >= RECENT), _fact("recent", crop))),
        "owner": F.array(_fact("owner", owner, crop)),
        "source": F.when(score.isNotNull(), each(F.col("data_sources"), lambda e: _fact("source", e, v=score))),
        "crop": F.array(F.when(score.isNotNull(), _fact("crop", crop, v=score))),
        "absent": F.array(_fact("absent", F.array_join(stats.absent_columns(df.columns), ","))),
    }


def fact_counts(df: DataFrame, kinds: Collection[str]) -> DataFrame:
    """``(kind, a, b, x, n, total)``: how often each fact stands, and the sum of its measure; one scan."""
    every = facts(df)
    lists = [F.coalesce(every[k], F.array().cast("array<struct<kind:string,a:string,b:string,x:double,v:double>>"))
             for k in every if k in kinds]
    rows = df.select(F.explode(F.concat(*lists)).alias("f")).where("f IS NOT NULL").select("f.*")
    return rows.groupBy("kind", "a", "b", "x").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


def row_totals(df: DataFrame, groups: Collection[str]) -> DataFrame:
    """One row of all that is no count of facts; one scan."""
    size = array_size("stressors_tolerated")
    number = stats.numeric_columns(df)
    every = {
        "missing": stats.missing_counts(df.columns), "describe": stats.describing(number), "correlations": stats.correlating(number),
        "elements": [F.count_if(size > 0).alias("rows_with_values"), F.count_if(size == 0).alias("rows_without_values"),
                     F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("total_values"), F.count_if(size >= 3).alias("rows_with_many")],
        "summary": kpis.totals(kpis.CATALOGUE),
    }
    return df.agg(*[c for name, columns in every.items() if name in groups for c in columns])


#: Report -> kinds of facts and groups of totals that it reads.
NEEDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "missing": ((), ("missing",)), "describe": (("number",), ("describe",)),
    "quality_flags": (("value",), ()), "confidence_levels": (("value",), ()), "unique": (("value",), ()), "crops": (("value",), ()),
    "completeness_histogram": (("number",), ()), "year_histogram": (("number",), ()), "maturity_histogram": (("number",), ()),
    "missing_correlations": (("absent",), ()),
    "stressors": (("element",), ()), "stressor_totals": ((), ("elements",)), "stressor_sizes": (("size",), ()),
    "stress_by_crop": (("cross",), ()), "stress_by_crop_top": (("cross",), ()), "states": (("element",), ()),
    "years": (("value",), ()), "decades": (("value",), ()), "recent_crops": (("recent",), ()), "institutions": (("value",), ()),
    "institution_diversity": (("owner",), ()), "specialists": (("owner",), ()),
    "quality_traits": (("element",), ()), "quality_trait_sizes": (("size",), ()), "multi_trait": ((), ()),
    "correlations": ((), ("correlations",)), "strong_pairs": ((), ("correlations",)),
    "completeness_by_source": (("source",), ()), "completeness_by_crop": (("crop",), ()), "usual_range": ((), ()),
    "summary": (("value", "element", "owner"), ("summary",)),
}


def profile_catalogue(df: DataFrame, only: Collection[str] | None = None) -> dict[str, DataFrame]:
    """Report name -> frame, all of ``NEEDS`` or those named.

    The counted facts and the row of totals are stored at once, each by one scan of ``df``; a report reads them when it is
    read itself. Facts are as many as the distinct values of the counted columns; nothing of them is collected.
    """
    wanted = list(NEEDS if only is None else only)
    kinds = {k for name in wanted for k in NEEDS[name][0]}
    groups = {g for name in wanted for g in NEEDS[name][1]}
    stored = stage_table(fact_counts(df, kinds)) if kinds else None
    totals = stage_table(row_totals(df, groups)) if groups else None
    number = stats.numeric_columns(df)

    def of(kind: str, a: str | None = None) -> DataFrame:
        rows = stored.where(F.col("kind") == kind)
        return rows if a is None else rows.where(F.col("a") == a)

    def values(column: str) -> DataFrame:
        return of("value", column).select(F.col("b").cast(df.schema[column].dataType).alias(column), F.col("n").alias("count"))

    def elements(column: str, alias: str) -> DataFrame:
        return of("element", column).select(F.col("b").alias(alias), F.col("n").alias("count"))

    def sizes(column: str) -> DataFrame:
        return of("size", column).select(F.col("x").cast("int").alias("size"), F.col("n").alias("count"))

    def bars(column: str, bins: int) -> DataFrame:
        return counts.histogram(of("number", column), "x", bins, weight="n")

    def crosses() -> DataFrame:
        return of("cross").select(F.col("a").alias("stress"), F.col("b").alias("crop_type"), F.col("n").alias("count"))

    def owners() -> DataFrame:
        return of("owner").select(F.col("a").alias("breeding_institution"), F.col("b").alias("crop_type"), F.col("n").alias("count"))

    def diversity() -> DataFrame:
        known = owners().where("breeding_institution IS NOT NULL AND crop_type IS NOT NULL")
        return known.groupBy("breeding_institution").agg(F.count("*").alias("count"))

    def means(kind: str, alias: str) -> DataFrame:
        return of(kind).select(F.col("a").alias(alias), (F.col("total") / F.col("n")).alias("mean"))

    def distinct(columns: tuple[str, ...]) -> DataFrame:
        found = of("value").groupBy(F.col("a").alias("column_name")).agg(F.count("*").alias("n"))
        named = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
        return named.join(found, "column_name", "left").select("column_name", F.coalesce("n", F.lit(0)).alias("unique_values"))

    def patterns() -> DataFrame:
        places = F.filter(F.split("a", ","), lambda t: t != "")
        return of("absent").select(F.transform(places, lambda t: t.cast("int")).alias("absent"), "n")

    def decades() -> DataFrame:
        return values("year_of_release").groupBy(decade("year_of_release").alias("decade")).agg(F.sum("count").alias("count"))

    def summary() -> DataFrame:
        distinct_of = lambda c: of("value", c).agg(F.count("*")).scalar()
        row = totals.withColumn("crop|distinct", distinct_of("crop_type")).withColumn(
            "institution|distinct", distinct_of("breeding_institution"))
        name = lambda frame, c: frame.withColumnRenamed(c, "name")
        return kpis.summary(row, {
            "crop": name(values("crop_type"), "crop_type"), "institution": name(values("breeding_institution"), "breeding_institution"),
            "diverse_institution": name(diversity(), "breeding_institution"), "trait": elements("stressors_tolerated", "name"),
            "state": elements("recommended_states", "name")})

    matrix = lambda: stats.correlation_rows(totals, number)
    quartiles = lambda: counted_quantiles(
        of("number").select(F.col("a").alias("column_name"), F.col("x").alias("value"), "n"), "column_name", stats.QUARTILES)
    builders: dict[str, Callable[[], DataFrame]] = {
        "missing": lambda: stats.missing_rows(totals, df.columns).orderBy(F.desc("missing_count"), "column_name"),
        "describe": lambda: stats.description(totals, quartiles(), number),
        "quality_flags": lambda: values("quality_flag"),
        "confidence_levels": lambda: values("confidence_level"),
        "unique": lambda: distinct(("variety_name", "crop_type", "breeding_institution")),
        "crops": lambda: values("crop_type"),
        "completeness_histogram": lambda: bars(SCORE, 20),
        "year_histogram": lambda: bars("year_of_release", 20),
        "maturity_histogram": lambda: bars("maturity_days", 15),
        "missing_correlations": lambda: stats.pattern_correlations(patterns(), df.columns),
        "stressors": lambda: counts.top_k(elements("stressors_tolerated", "stress"), 15),
        "stressor_totals": lambda: totals.select("rows_with_values", "rows_without_values", "total_values", "rows_with_many"),
        "stressor_sizes": lambda: sizes("stressors_tolerated"),
        "stress_by_crop": crosses,
        "stress_by_crop_top": lambda: counts.top_cross_counts(crosses(), "stress", "crop_type"),
        "states": lambda: counts.top_k(elements("recommended_states", "state"), 15),
        "years": lambda: values("year_of_release"),
        "decades": decades,
        "recent_crops": lambda: counts.top_k(of("recent").select(F.col("a").alias("crop_type"), F.col("n").alias("count")), 10),
        "institutions": lambda: counts.top_k(values("breeding_institution"), 15),
        "institution_diversity": lambda: counts.top_k(diversity(), 10),
        "specialists": lambda: counts.leading_owners(owners().where("crop_type IS NOT NULL"), "crop_type", "breeding_institution"),
        "quality_traits": lambda: counts.top_k(elements("quality_traits", "trait"), 15),
        "quality_trait_sizes": lambda: sizes("quality_traits"),
        "multi_trait": lambda: multi_trait(df),
        "correlations": matrix,
        "strong_pairs": lambda: stats.strong_pairs(matrix()),
        "completeness_by_source": lambda: counts.top_k(means("source", "source"), 10, "mean"),
        "completeness_by_crop": lambda: means("crop", "crop_type").orderBy(F.desc("mean"), "crop_type"),
        "usual_range": lambda: usual_range(df),
        "summary": summary,
    }
    return {name: builders[name]() for name in wanted}
