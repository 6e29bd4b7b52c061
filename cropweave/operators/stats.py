"""Summary statistics, missingness, profiles and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropweave.functions.text import percent
from cropweave.operators.ordering import exact_quantiles_by
from cropweave.session import stage_table


PROFILE_COLUMNS = 4
#: Rows of a task that counts distinct values.
TASK_ROWS = 1 << 17
QUARTILES = (0.25, 0.5, 0.75)
_BASICS = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def _long(row: DataFrame, entries: Sequence[tuple]) -> DataFrame:
    """Turn a one-row aggregate into rows of named expressions."""
    return row.select(F.explode(F.array(*[F.struct(*e) for e in entries])).alias("e")).select("e.*")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def unique_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    row = df.agg(*[count(F.col(c)).alias(c) for c in columns])
    return _long(row, [(F.lit(c).alias("column_name"), F.col(c).alias("unique_values")) for c in columns])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation) and max per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")
    quartiles = exact_quantiles_by(long, "column_name", "value", QUARTILES)
    return description(df.agg(*describing(columns)), quartiles, columns)


def describing(columns: Sequence[str]) -> list[Column]:
    """Aggregates that ``description`` reads."""
    return [f(F.col(c).cast("double")).alias(f"{c}|{n}") for c in columns for n, f in _BASICS.items()]


def description(row: DataFrame, quartiles: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``describe`` from its one-row aggregate and the quartiles (column_name, probability, value)."""
    basics = _long(row, [(F.lit(c).alias("column_name"), *[F.col(f"`{c}|{n}`").alias(n) for n in _BASICS]) for c in columns])
    pick = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    wide = quartiles.groupBy("column_name").agg(pick(0.25).alias("q25"), pick(0.5).alias("q50"), pick(0.75).alias("q75"))
    return (basics.join(F.broadcast(wide), "column_name", "left")
            .select("column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


def missing_stats(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing count and percent per column, in one pass."""
    return missing_rows(df.agg(*missing_counts(df.columns)), df.columns, only_missing)


def missing_counts(columns: Sequence[str]) -> list[Column]:
    """Aggregates that ``missing_rows`` reads."""
    return [F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}|missing") for c in columns]]


def missing_rows(row: DataFrame, columns: Sequence[str], only_missing: bool = True) -> DataFrame:
    stats = _long(row, [(F.lit(c).alias("column_name"), F.col(f"`{c}|missing`").alias("missing_count"),
                         percent(F.col(f"`{c}|missing`"), F.col("_n")).alias("missing_percentage")) for c in columns])
    return stats.where(F.col("missing_count") > 0) if only_missing else stats


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, missing count and percent, distinct values and a nested flag per column.

    Exact distinct counts multiply a row by the columns they are taken of, so few columns share an aggregate; each one
    reads only its own. A task holds every value it meets, so the rows, which are counted first, are dealt to as many tasks
    as ``TASK_ROWS`` asks for, and SHA-256 digests stand for nested values. Hand in a stored table.
    """
    nested = {f.name: isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) for f in df.schema.fields}
    text = lambda c: F.to_json(F.col(f"`{c}`")) if nested[c] else F.col(f"`{c}`")
    digest = lambda c: F.unhex(F.sha2(text(c), 256)) if nested[c] else text(c)
    distinct, value = (F.approx_count_distinct, text) if approximate else (F.count_distinct, digest)
    tasks = 1 if approximate else -(-df.count() // TASK_ROWS)

    def profiled(columns: Sequence[str]) -> DataFrame:
        values = df.select(*[value(c).alias(c) for c in columns])
        dealt = values.repartition(tasks) if tasks > 1 else values
        row = dealt.agg(F.count("*").alias("_n"),
                        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}|m") for c in columns],
                        *[distinct(F.col(f"`{c}`")).alias(f"{c}|u") for c in columns])
        return _long(row, [(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                            F.col(f"`{c}|m`").alias("missing_values"),
                            F.try_divide(F.col(f"`{c}|m`") * 100.0, F.col("_n")).alias("missing_percent"),
                            F.col(f"`{c}|u`").alias("unique_values"), F.lit(nested[c]).alias("nested"))
                           for c in columns])

    size = len(df.columns) if approximate else PROFILE_COLUMNS
    return reduce(DataFrame.unionByName, [profiled(df.columns[i:i + size]) for i in range(0, len(df.columns), size)])


def correlating(columns: Sequence[str]) -> list[Column]:
    """Aggregates that ``correlation_rows`` reads: every column pair i <= j, rows with a null on either side left out.

    Null where a column is constant over the rows used (``corr`` itself would divide by zero).
    """
    def correlation(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    return [correlation(a, b).alias(f"{a}|{b}") for i, a in enumerate(columns) for b in columns[i:]]


def correlation_rows(row: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _long(row, [(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"`{a}|{b}`").alias("correlation"))
                       for i, a in enumerate(columns) for b in columns[i:]])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle of the correlation matrix, diagonal included."""
    return correlation_rows(df.agg(*correlating(columns)), columns)


def missing_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of the missing-value indicators of every column pair i <= j, null where one is constant.

    Rows are counted by their set of missing columns first; pairs are counted over these sets.
    """
    patterns = stage_table(df.select(absent_columns(columns).alias("absent")).groupBy("absent").agg(F.count("*").alias("n")))
    return pattern_correlations(patterns, columns)


def absent_columns(columns: Sequence[str]) -> Column:
    """Places of the columns that a row lacks."""
    return F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(i)) for i, c in enumerate(columns)]))


def pattern_correlations(patterns: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``missing_correlations`` from a stored table of the sets of missing columns (absent, n)."""
    together = F.flatten(F.transform("absent", lambda a: F.transform(
        F.filter("absent", lambda b: b >= a), lambda b: F.struct(a.alias("i"), b.alias("j")))))
    counts = patterns.select("n", F.explode(together).alias("p")).groupBy("p.i", "p.j").agg(F.sum("n").alias("both"))
    single = counts.where("i = j")
    every = [(i, j, a, b) for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j]
    pairs = patterns.sparkSession.createDataFrame(every, "i int, j int, column_a string, column_b string")
    total = patterns.agg(F.sum("n").cast("double")).scalar()
    joined = (pairs.join(counts, ["i", "j"], "left").join(single.select("i", F.col("both").alias("a")), "i", "left")
              .join(single.select("j", F.col("both").alias("b")), "j", "left").withColumn("_n", total))
    share = lambda c: F.coalesce(c, F.lit(0)) / F.col("_n")
    x, y = share("a"), share("b")
    return joined.select("column_a", "column_b", F.try_divide(
        share("both") - x * y, F.sqrt(x * (1 - x)) * F.sqrt(y * (1 - y))).alias("correlation"))


def strong_pairs(matrix: DataFrame, above: float = 0.5) -> DataFrame:
    return matrix.where((F.col("column_a") != F.col("column_b")) & (F.abs("correlation") > above))


#: Logarithm of the buckets of a stored distinct-count sketch; the standard error is about 0.8 %.
SKETCH_BITS = 14


def batch_profile(df: DataFrame) -> DataFrame:
    """``(column_name, dtype, nested, rows, missing_values, sketch)`` of one batch, in one pass.

    Counts of batches add up, and their sketches of distinct values can be united, so a table that grows is profiled batch
    by batch and never read again.
    """
    nested = {f.name: isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) for f in df.schema.fields}
    value = lambda c: F.to_json(F.col(f"`{c}`")) if nested[c] else F.col(f"`{c}`").cast("string")
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}|m") for c in df.columns],
                 *[F.hll_sketch_agg(value(c), F.lit(SKETCH_BITS)).alias(f"{c}|s") for c in df.columns])
    return _long(row, [(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                        F.lit(nested[c]).alias("nested"), F.col("_n").alias("rows"), F.col(f"`{c}|m`").alias("missing_values"),
                        F.col(f"`{c}|s`").alias("sketch")) for c in df.columns])


def add_batch(df: DataFrame, path: str, batch: str) -> None:
    """Store the profile of a batch; writing the batch once more replaces it."""
    (batch_profile(df).withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(path))


def grown_profile(stored: DataFrame) -> DataFrame:
    """``column_profile`` of all rows from the stored profiles of their batches.

    Rows and missing values are exact, distinct values are estimated with a standard error of about 0.8 %. A column that
    earlier batches did not have is missing in all their rows.
    """
    total = stored.groupBy("batch").agg(F.max("rows").alias("rows")).agg(F.sum("rows")).scalar()
    merged = stored.groupBy("column_name").agg(
        F.max_by("dtype", "batch").alias("dtype"), F.sum(F.col("rows") - F.col("missing_values")).alias("_known"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_values"), F.bool_or("nested").alias("nested"))
    missing = total - F.col("_known")
    return merged.select("column_name", "dtype", missing.alias("missing_values"),
                         F.try_divide(missing * 100.0, total).alias("missing_percent"), "unique_values", "nested")
