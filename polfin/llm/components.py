"""Connected components of an edge table, by alternating stars.

Each round is two groupings and joins over the edges: every node points the larger
(then the smaller) of its neighbours to the smallest one it knows. Paths shrink
geometrically, so rounds are logarithmic. Edges live in the shared folder between
rounds and never pass through the driver; only their count and checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polfin.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = edges.select(F.explode(ends).alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with u > v. Of each node the edge to its least neighbour stays, the other neighbours go to that one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    end = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return edges.join(least, "u").select(end.alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the component's smallest node.

    Loops and repeated edges are fine; roots are listed too.
    """
    now = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        row = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (row.n, row.x) == state:
            break
        state = (row.n, row.x)
        now = stored(_small_star(stored(_large_star(now), "large-star")), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
