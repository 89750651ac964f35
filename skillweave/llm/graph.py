"""Connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.session import cut_lineage


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star operation: neighbours of a node are linked to the least of them instead.

    Large: neighbours above the node. Small: neighbours below it, and the node itself.
    """
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    met = both.join(least, "u")
    moved = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("least").alias("b")) if large else (
        met.where(F.col("v") != F.col("least")).select(F.col("v").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select(F.col("u").alias("a"), F.col("least").alias("b")))
    )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node``, ``root``: each node of the links ``a``-``b`` with the least node it can reach.

    Large and small stars alternate until nothing moves, so the rounds grow with the logarithm of the
    longest chain. Links are never expanded to pairs of a component; every round ends in a checkpoint.
    Nulls and loops count as no link; an empty table gives an empty table.
    """
    now = cut_lineage(pairs.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        nxt = cut_lineage(_star(_star(now, large=True), large=False))
        found = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == (found.n, found.s) or not found.n:
            return nxt.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now, state = nxt, (found.n, found.s)
