"""Connected components of a distributed edge table by alternating stars.

Each round joins an edge table with the least neighbour of each node (large
star), then links each node's smaller neighbours to the least (small star).
Rounds are written under ``spark.checkpoint.dir``; they end when a round leaves
the edges as they were.  No component is ever gathered in one place: the least
neighbour is a partial aggregation and a hub's rows are joined by a sort-merge
join whose large partitions Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretable.llm.frames import stored_with


def _signed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    print_ = F.xxhash64("u", "v")
    out, seen = stored_with(edges, n=F.count(F.lit(1)), a=F.sum(F.shiftright(print_, 20)),
                                     b=F.bit_xor(print_))
    return out, (seen["n"], seen["a"], seen["b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns u, v (bigint, u != v, any order, repeats allowed).

    Returns node, root for every node that is not its component's least node.
    An empty table gives an empty result.
    """
    now, mark = _signed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u != v").distinct())
    while mark[0]:
        # Large star: every neighbour above the node is linked to the least of node and neighbours.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .where("u != v").distinct())
        # Small star: u > v holds now; the smaller neighbours and the node are linked to the least.
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(least, "u")
        new = (small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
               .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        new, then = _signed(new)
        if then == mark:
            break
        now, mark = new, then
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
