"""Connected components of a graph of links, by alternating large and small stars over stored edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise

#: Edges halve their depth in each round, so this many reach across any graph that a table can hold.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("low", "high")).toDF("node", "next")
    least = both.groupBy("node").agg(F.least("node", F.min("next")).alias("least"))
    return both.where("next > node").join(least, "node").select(F.col("next").alias("high"), F.col("least").alias("low"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    others = edges.join(least, "high").where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return others.union(least.toDF("high", "low"))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(high, low))")).first())


def component_stars(links: DataFrame, at_most: int | None = None) -> DataFrame:
    """From links (high, low) with high > low: each node but the smallest of its component, with that smallest.

    ``at_most`` is a bound on the links, if there is one. The stars are stored after each round, so a lost executor repeats one round at most. Joins are on a node;
    nodes with very many links are split by adaptive execution, as their other side has one row for each node.
    """
    stars = materialise(links.select("high", "low").distinct(), "stars", at_most)
    before = _fingerprint(stars)
    for _ in range(MOST_ROUNDS if before[0] else 0):
        # A round never has more edges than the one before.
        stars = materialise(_small_star(_large_star(stars).distinct()).distinct(), "stars", before[0])
        now = _fingerprint(stars)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError(f"groups of links still changed after {MOST_ROUNDS} rounds")
    return stars
