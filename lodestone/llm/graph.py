"""Connected components as a distributed, converging iteration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import hot_keys, materialise, spread_join


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the undirected edges ``(u, v)``.

    ``component`` is the smallest node reachable. Alternates large-star and
    small-star steps (Kiveris et al., 2014) until the edges no longer change;
    each step needs only the smallest neighbour of a node, which is aggregated
    before the shuffle and joined to the node's edges in parts, so a node with very
    many neighbours is no hot group.
    Every round is written to the shared folder. Loops and repeated edges are
    harmless; nodes without edges are not returned; no edges give no rows.
    """

    def proper(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    now, before = materialise(proper(edges), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        above = now.select(F.col("v").alias("u"), F.col("u").alias("v"))
        hot = hot_keys(above.groupBy("u").agg(F.count("*").alias("n")), "u")
        large = proper(spread_join(above, least, ["u"], hot).select(F.col("v").alias("u"), F.col("m").alias("v")))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = materialise(proper(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))), "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
