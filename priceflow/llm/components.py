"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from priceflow.session import hand_off, scratch_path, scratch_scope


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours (the larger or the smaller ones) to the smallest node around it."""
    both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    mine = both if large else both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    linked = mine.join(least, "u").withColumn("m", F.least("u", "least"))
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return linked.select(F.inline(pairs)).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node with an edge can reach: node, component.

    ``edges`` has the columns u and v of one type; the direction and repeats don't matter. Every step
    is a group-by with a minimum and a join on its result, so a node with very many edges is
    pre-aggregated and split. The table of edges never grows; the number of rounds is logarithmic. Each round
    ends in a written table, so no lineage piles up and a lost executor costs one round at most. These tables are deleted at the end.
    """
    path = scratch_path(edges.sparkSession, "components")
    with scratch_scope(edges.sparkSession):
        return hand_off(_labels(edges), path)


def _labels(edges: DataFrame) -> DataFrame:
    spark = edges.sparkSession
    current = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    state = None
    while True:
        seen = Observation()
        stars = _star(_star(current, large=True), large=False)
        stars = stars.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        current = hand_off(stars, scratch_path(spark, "stars"))
        if seen.get == state:
            break
        state = seen.get
    own = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")), F.struct(F.col("v").alias("node"), F.col("v").alias("component")))
    return current.select(F.inline(own)).distinct()
