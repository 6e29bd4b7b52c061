"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropweave.session import stage_table

MAX_ROUNDS = 64


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the smallest node of the component.

    Each round lets every node point its neighbours at the smallest node it knows. The number of links never grows, the
    rounds grow with the logarithm of the longest path, and each round is a pre-aggregated minimum and a join that
    adaptive execution can split. Rounds are written to the shared folder, so a lost executor re-runs one round only.
    Loops and repeated links are allowed; rows with a null end are no links. An empty table gives an empty table.
    """
    edges = (links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = stage_table(edges)
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.filter("b > a").join(least, "a").filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = stage_table(large.join(small_least, "a")
                            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                            .select("e.a", "e.b").filter("a <> b").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
