"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step: each node links its (larger, or smaller) neighbours to its least neighbour."""
    both = pairs.select("u", "v").where("u <> v")
    if large:
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("n", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("n"))
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) of every node in edges (two bigint columns); a component is named by its least node.

    Rows with a null or with equal ends add nothing. Each round contracts paths, so rounds grow with the logarithm of the
    longest one; every round is written to the shared folder, and deleted after the next. No edges give no rows.
    """
    pairs = materialize(edges.toDF("u", "v").where("u is not null and v is not null and u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        had, pairs = pairs, materialize(_star(_star(pairs, True), False))
        release(had)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
