"""Connected components of a graph given as an edge table.

Each round every node points to the neighbour of least random rank (or to
itself), the edges move to the nodes pointed at, and edges inside one node
and repeated edges go.  The order is drawn anew each round, so the expected
number of nodes with edges falls by a constant factor.  All steps are joins
and partial aggregations; the edges of a round are cut by a checkpoint.
Nothing but the edge count of a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.llm.common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the nodes of a
    component share one root.  Null ends, loops and repeated edges are
    ignored; no edges give an empty table."""
    edges = cut(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                .where("u <> v").distinct())
    root: DataFrame | None = None
    turn = 0
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = F.xxhash64(F.lit(turn), F.col("v"))
        own = F.xxhash64(F.lit(turn), F.col("u"))
        best = (both.groupBy("u").agg(F.min(F.struct(rank.alias("r"), F.col("v").alias("v"))).alias("m"))
                .select(F.col("u").alias("node"),
                        F.when(F.struct(own.alias("r"), F.col("u").alias("v")) < F.col("m"), F.col("u")).otherwise(F.col("m.v")).alias("to")))
        best = cut(best)
        moved = (edges.join(best.select(F.col("node").alias("u"), F.col("to").alias("a")), "u")
                 .join(best.select(F.col("node").alias("v"), F.col("to").alias("b")), "v"))
        edges = cut(moved.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
        if root is None:
            root = best.withColumnRenamed("to", "root")
        else:
            root = cut(root.join(best.select(F.col("node").alias("root"), "to"), "root", "left")
                       .select("node", F.coalesce("to", "root").alias("root")))
        turn += 1
    return root if root is not None else edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
