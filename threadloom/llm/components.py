"""Connected components by alternating stars over stored edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it sees."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"),
                                                           F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them; here u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"),
                                                          F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns node, root: the smallest node that each node of an edge reaches.

    Edges are columns u and v in any order. Rounds go on until the edges stay as they are, which
    takes about as many as the logarithm of the largest component. Roots have no row. Every round is
    stored in the shared folder; only a count and a checksum reach the driver.
    """
    current = stored(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(), "edges")
    before = None
    while True:
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or state[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(state)
        current = stored(_small_star(_large_star(current)), "stars")
