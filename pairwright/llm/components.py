"""Connected components of a graph given as links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them: the larger ones, or the smaller ones and the node."""
    pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    met = pairs.join(least, "u")
    if large:
        linked = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return linked.where("u > v").distinct()


def component_roots(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node that has a link: the smallest node reachable from it.

    ``links`` has two long columns; direction, repeats and loops don't matter. Each round is stored, so a lost executor
    costs no earlier round. Nodes with many links are reduced before the shuffle. Only a count and a checksum of the links
    come to the driver. A step keeps components as they are, and the links end as one star for each component.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = materialize(edges, "links")
    mark = None
    for _ in range(max_rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = state
        edges = materialize(_star(_star(edges, large=True), large=False), "links")
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
