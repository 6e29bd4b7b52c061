"""Join of names by the words they share, in any order: all pairs whose weighted word sets are similar enough.

For a similarity of t the shared weight is at least t times the weight of either set. So if the words of a set are put in
one common order, rarest first, two similar sets share a word among those that stand before the rest weighs less than
t times the set. Only these words meet, and only sets whose weights allow the similarity. A word that very many sets have
in front is split into a grid of cells, left sets by row and right sets by column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropweave.functions.similarity import tokens
from cropweave.functions.text import compare_key
from cropweave.session import stage_table

#: Sets of either side that meet in one cell of a common word.
CELL_SETS = 4_096


def _weighted(words: Column, weight: str) -> Column:
    """Sum of the weights of an array of (n, word) structs."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + w[weight])


def similar_sets(left: DataFrame, right: DataFrame, *, left_name: str, right_name: str, percent: int = 60, rarity: bool = False) -> DataFrame:
    """``(left_key, right_key, shared, weight, similarity)``: all pairs of distinct keys with a weighted Jaccard of ``percent`` or more.

    Keys are compared as sets of the words of their compare form; without a word a key is similar to none. A word weighs 1,
    or, with ``rarity``, 100 times the logarithm of one more than all keys over its keys, as a whole number of at least 1.
    ``shared`` is the weight of the common words, ``weight`` that of all words of both. Every distinct key counts once, so a
    name that a third of all rows has costs one.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")

    def keys(df: DataFrame, name: str) -> DataFrame:
        # words in any order are one set, and keys with one set are one entry
        distinct = df.select(compare_key(name).alias("key")).where("key <> ''").distinct()
        return stage_table(distinct.select("key", F.array_sort(F.array_distinct(tokens("key"))).alias("words")))

    a, b = keys(left, left_name), keys(right, right_name)
    sets = a.select("words").unionByName(b.select("words")).distinct()
    found = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    total = sets.agg(F.count("*")).scalar()
    heavy = F.greatest(F.round(100 * F.log1p(total / F.col("n"))).cast("long"), F.lit(1)) if rarity else F.lit(1).cast("long")
    frequency = stage_table(found.select("word", "n", heavy.alias("w")))

    def fronted(df: DataFrame, side: str) -> DataFrame:
        """A row for each word in front of a set, with the set and its weight."""
        words = (df.select("words").distinct().select("words", F.explode("words").alias("word")).join(frequency, "word")
                 .groupBy("words").agg(F.array_sort(F.collect_list(F.struct("n", "word", "w"))).alias("order")))
        whole = words.withColumn("weight", _weighted(F.col("order"), "w"))
        # words before the place from which the rest weighs less than percent of the whole
        places = F.filter(F.sequence(F.lit(1), F.size("order")), lambda i: 100 * _weighted(
            F.slice("order", i, F.size("order")), "w") >= percent * F.col("weight"))
        return whole.select(F.col("words").alias(f"{side}_words"), F.col("weight").alias(f"{side}_weight"),
                            F.explode(F.transform(places, lambda i: F.get("order", i - 1)["word"])).alias("word"))

    one, two = stage_table(fronted(a, "left")), stage_table(fronted(b, "right"))
    sizes = [df.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") > CELL_SETS) for df in (one, two)]
    crowded = stage_table(sizes[0].unionByName(sizes[1]).groupBy("word").agg((F.floor(F.max("n") / CELL_SETS) + 1).cast("int").alias("splits")))

    def celled(df: DataFrame, side: str, own: str, other: str) -> DataFrame:
        known = df.join(crowded, "word", "left").withColumn("splits", F.coalesce("splits", F.lit(1)))
        return known.withColumn(own, F.pmod(F.xxhash64(f"{side}_words"), F.col("splits")).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).drop("splits")

    met = celled(one, "left", "row", "column").join(celled(two, "right", "column", "row"), ["word", "row", "column"])
    fits = 100 * F.least("left_weight", "right_weight") >= percent * F.greatest("left_weight", "right_weight")
    pairs = met.where(fits).select("left_words", "right_words", "left_weight", "right_weight").distinct()
    if rarity:
        common = (pairs.withColumn("word", F.explode(F.array_intersect("left_words", "right_words"))).join(frequency, "word")
                  .groupBy("left_words", "right_words", "left_weight", "right_weight").agg(F.sum("w").alias("shared")))
    else:
        common = pairs.withColumn("shared", F.size(F.array_intersect("left_words", "right_words")).cast("long"))
    united = F.col("left_weight") + F.col("right_weight") - F.col("shared")
    similar = common.withColumn("weight", united).where(100 * F.col("shared") >= percent * F.col("weight"))
    named = lambda df, side: df.select(F.col("words").alias(f"{side}_words"), F.col("key").alias(f"{side}_key"))
    return (similar.join(named(a, "left"), "left_words").join(named(b, "right"), "right_words")
            .select("left_key", "right_key", "shared", "weight", (F.col("shared") / F.col("weight")).alias("similarity")))
