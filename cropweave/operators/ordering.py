"""Global positions, sequential ids and exact quantiles without a one-task sort.

Rows go to key ranges, each range is sorted by its own task, and the result is written once with the number of its range
and the place in it. A row's place in the total order is (weight of all earlier ranges) + (its place in its range), so
only one row per range is ever brought together. The number of ranges is that of the shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropweave.session import stage_table

# monotonically_increasing_id counts the rows of a partition in its lower 33 bits.
_ROW_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[str], column: str = "position", weight: str | None = None) -> DataFrame:
    """Add the 0-based place of each row in the total order of ``order`` (non-null columns).

    With ``weight`` the place is the summed weight of all rows before this one. The rows are stored at once.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = stage_table(ranged.select("*", F.spark_partition_id().alias("_range"),
                                       F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_place")))
    if weight:
        earlier = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        stored = stored.withColumn("_place", F.coalesce(F.sum(F.col(weight).cast("long")).over(earlier), F.lit(0)))
    sizes = stored.groupBy("_range").agg(F.sum(F.col(weight).cast("long") if weight else F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (stored.join(F.broadcast(starts), "_range")  # a row per shuffle partition
            .withColumn(column, F.col("_start") + F.col("_place")).drop("_range", "_place", "_start"))


def with_sequential_id(df: DataFrame, order: Sequence[str], column: str, prefix: str) -> DataFrame:
    """Ids ``<prefix>000001, <prefix>000002, ...`` in the order of ``order``."""
    ranked = with_position(df, order, "_position")
    text = F.format_string(prefix + "%06d", F.col("_position") + 1)
    return ranked.withColumn(column, text).drop("_position")


def id_check(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, distinct ids, and whether every id is unique and present."""
    per_id = df.groupBy(column).agg(F.count("*").alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(column).alias("unique_ids"),
    ).withColumn("is_unique", F.col("total_rows") == F.col("unique_ids"))


def require_unique(df: DataFrame, column: str) -> None:
    """Raise when an id repeats or is null (an action)."""
    row = id_check(df, column).first()
    if not row.is_unique:
        raise ValueError(f"{column}: {row.unique_ids} unique ids in {row.total_rows} rows")


def exact_quantiles_by(df: DataFrame, group: str, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles (group, probability, value) from exact order statistics; nulls are ignored.

    Equal values are counted first; all groups are placed in one range-partitioned pass.
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(F.col(group), F.col(value).cast("double").alias("value"))
              .agg(F.count("*").alias("n")))
    return counted_quantiles(counts, group, probabilities)


def counted_quantiles(counts: DataFrame, group: str, probabilities: Sequence[float]) -> DataFrame:
    """``exact_quantiles_by`` from counted values (group, value, n)."""
    placed = with_position(counts, [group, "value"], "_before", weight="n")
    totals = placed.groupBy(group).agg(F.sum("n").alias("_total"), F.min("_before").alias("_first"))
    rank = lambda p: (F.col("_total") - 1) * F.lit(float(p))
    # One target per probability: its fractional rank, between the two order statistics it interpolates.
    targets = F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.floor(rank(p)).alias("low"), F.ceil(rank(p)).alias("high"),
                 (rank(p) - F.floor(rank(p))).alias("share")) for p in probabilities])
    start = F.col("_before") - F.col("_first")

    def covered(wanted: Column) -> Column:
        return (start <= wanted) & (wanted < start + F.col("n"))

    hit = (placed.join(totals, group).select("*", F.explode(targets).alias("t"))
           .where(covered(F.col("t.low")) | covered(F.col("t.high"))))
    at = lambda wanted: F.max(F.when(covered(F.col(wanted)), F.col("value")))
    low, high = F.col("low_value"), F.col("high_value")
    return (hit.groupBy(group, F.col("t.probability").alias("probability"))
            .agg(at("t.low").alias("low_value"), at("t.high").alias("high_value"), F.max("t.share").alias("share"))
            .select(group, "probability", (low + (high - low) * F.col("share")).alias("value")))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Quantiles (probability, value) of one column."""
    one = df.select(F.lit(0).alias("_group"), F.col(column).alias("_value"))
    return exact_quantiles_by(one, "_group", "_value", probabilities).drop("_group")
