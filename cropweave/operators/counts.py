"""Counts, cross tables and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropweave.functions.jsonio import array_size
from cropweave.functions.text import as_col, decade
from cropweave.session import stage_table


def value_counts(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Rows per value, nulls left out. Order it with ``top_k`` when a report wants it ordered."""
    name = alias or column
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(name)).agg(F.count("*").alias("count"))


def top_k(counts: DataFrame, k: int, value: str = "count") -> DataFrame:
    """The ``k`` largest rows; ties are broken by the other columns, so the result is fixed."""
    others = [F.col(c) for c in counts.columns if c != value]
    return counts.orderBy(F.desc(value), *others).limit(k)


def elements(df: DataFrame, array: str, alias: str, *keep: str) -> DataFrame:
    """One row per array element, with the columns to keep.

    The outer form, as a plain explode filters on the array first and so computes a derived array several times.
    """
    return df.select(*keep, F.explode_outer(array).alias(alias)).where(F.col(alias).isNotNull())


def element_counts(df: DataFrame, array: str, alias: str) -> DataFrame:
    """Occurrences of each array element over all rows."""
    return value_counts(elements(df, array, alias), alias)


def element_totals(df: DataFrame, array: str, many: int = 3) -> DataFrame:
    """Rows with an element, all elements, rows with at least ``many`` elements."""
    size = array_size(array)
    return df.agg(F.count_if(size > 0).alias("rows_with_values"), F.count_if(size == 0).alias("rows_without_values"),
                  F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("total_values"),
                  F.count_if(size >= many).alias("rows_with_many"))


def cross_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Long cross table (row, column, count); the form to use when either side has many values."""
    both = F.col(row).isNotNull() & F.col(column).isNotNull()
    return df.where(both).groupBy(row, column).agg(F.count("*").alias("count"))


def cross_table(counts: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Wide cross table over a given, bounded list of column values, zeros filled in."""
    cells = [F.coalesce(F.sum(F.when(F.col(column) == v, F.col("count"))), F.lit(0)).cast("long").alias(str(v))
             for v in values]
    return counts.groupBy(row).agg(*cells)


def top_cross_counts(counts: DataFrame, row: str, column: str, rows: int = 10, columns: int = 8) -> DataFrame:
    """Cells of the ``rows`` x ``columns`` sub-table with the largest totals, zeros filled in."""
    counts = stage_table(counts)  # read for both marginals and for the cells

    def leading(name: str, k: int) -> DataFrame:
        return top_k(counts.groupBy(name).agg(F.sum("count").alias("count")), k).select(name)

    # The leading columns are one short array, so the grid is an explode and holds rows * columns entries.
    names = leading(column, columns).agg(F.collect_list(column)).scalar()
    grid = leading(row, rows).select(row, F.explode(names).alias(column))
    cells = grid.join(counts, [row, column], "left")
    return cells.select(row, column, F.coalesce("count", F.lit(0)).alias("count"))


def histogram(df: DataFrame, column: str, bins: int, weight: str | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed and empty bins are listed.

    A constant column gets a range of one around its value. With ``weight`` a row stands for so many.
    """
    x = F.col(column).cast("double")
    known = df.where(x.isNotNull()).select(x.alias("x"), (F.col(weight) if weight else F.lit(1)).alias("n"))
    flat = F.min("x") == F.max("x")
    ends = known.agg(F.struct(F.when(flat, F.min("x") - 0.5).otherwise(F.min("x")).alias("lo"),
                              F.when(flat, F.max("x") + 0.5).otherwise(F.max("x")).alias("hi")).alias("ends"))
    end = ends.scalar()
    share = (F.col("x") - end["lo"]) / (end["hi"] - end["lo"])
    place = F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int")
    counts = known.groupBy(place.alias("bin")).agg(F.sum("n").alias("count"))
    width = (F.col("ends.hi") - F.col("ends.lo")) / bins
    every = (ends.where(F.col("ends.lo").isNotNull())
             .select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.col("ends.lo").alias("lo"),
                     width.alias("width")))
    return (every.join(counts, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def size_histogram(df: DataFrame, array: str) -> DataFrame:
    """Rows per array size."""
    return df.groupBy(array_size(array).alias("size")).agg(F.count("*").alias("count"))


def decade_counts(df: DataFrame, year: str) -> DataFrame:
    return (df.where(F.col(year).isNotNull()).groupBy(decade(year).alias("decade"))
            .agg(F.count("*").alias("count")))


def recent_counts(df: DataFrame, group: str, year: str, since: int = 2010) -> DataFrame:
    """Rows per group from the year ``since`` on."""
    return value_counts(df.where(F.col(year) >= since), group)


def diversity(df: DataFrame, owner: str, item: str) -> DataFrame:
    """Distinct items per owner."""
    pairs = df.where(F.col(owner).isNotNull() & F.col(item).isNotNull()).select(owner, item).distinct()
    return pairs.groupBy(owner).agg(F.count("*").alias("count"))


def specialists(df: DataFrame, group: str, owner: str, groups: int = 5, owners: int = 3) -> DataFrame:
    """The leading owners of each of the largest groups."""
    return leading_owners(stage_table(df.where(F.col(group).isNotNull()).groupBy(group, owner).agg(F.count("*").alias("count"))),
                          group, owner, groups, owners)


def leading_owners(pairs: DataFrame, group: str, owner: str, groups: int = 5, owners: int = 3) -> DataFrame:
    """``specialists`` from a stored count table (group, owner, count)."""
    leading = top_k(pairs.groupBy(group).agg(F.sum("count").alias("count")), groups).select(group)
    counts = pairs.where(F.col(owner).isNotNull()).join(F.broadcast(leading), group, "left_semi")
    order = Window.partitionBy(group).orderBy(F.desc("count"), owner)
    return (counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= owners))


def mean_by(df: DataFrame, group: Column | str, value: str, alias: str) -> DataFrame:
    """Mean of the non-null values per group."""
    g = as_col(group)
    return df.where(F.col(value).isNotNull()).groupBy(g.alias(alias)).agg(F.avg(value).alias("mean"))


def cap_per_group(df: DataFrame, group: str, order: Sequence[str], cap: int) -> DataFrame:
    """At most ``cap`` rows per group, the first ones in the given order."""
    return first_per_group(df, [group], order, cap)


def first_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[str], n: int, salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each group in the order of ``order``.

    A group is dealt over ``salts`` parts by a hash of the order columns. Each part keeps its first ``n`` rows, and the
    first ``n`` of the at most ``salts * n`` survivors are the group's, so no task sorts a whole group for any ``n``.
    """
    def kept(rows: DataFrame, *keys: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("_n", place).where(F.col("_n") <= n).drop("_n")

    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    return kept(kept(salted, *groups, "_salt").drop("_salt"), *groups)
