"""Connected components by alternating large-star and small-star.

Every round is two aggregations and two joins over the edge list; nothing is
gathered per node, so a hub with a third of all edges is one partial minimum per
task and a join key that adaptive execution splits.  Both stars are written to the
shared folder, so a lost executor repeats one star at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over (u, v) edges, u > v."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialise(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "cc-low")
    joined = both.join(low, "u")
    if small:      # u's smaller neighbours and u itself go to the least of them
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:          # u's larger neighbours go to the least of all
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct().select(F.col("a").alias("u"), F.col("b").alias("v"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one has none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.filter("up > 1 or (up > 0 and down > 0)").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the (u, v) links; component is the least node reachable.

    Null ends and loops are ignored; repeated links and either direction are fine;
    no links give an empty table.  Nodes may be of any ordered type.
    """
    edges = materialise(links.filter("u is not null and v is not null and u <> v")
                        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    while not _stars(edges):
        large = materialise(_star(edges, small=False), "cc-large")
        edges = materialise(_star(large, small=True), "cc-small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
