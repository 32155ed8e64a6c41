"""Connected components by contraction, with nothing gathered in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of a link (``a, b``); nodes of one component share their root.

    Every round each node takes the neighbour (or itself) of the smallest hash as its parent, and
    links are redrawn between parents until none is left.  The hash differs by round, so that long
    paths shrink by a constant share.  Links of a node with itself, repeated links and links with a
    null end change nothing.
    """
    live = cut(
        links.where(F.col("a") != F.col("b")).select("a", "b")
        .union(links.where(F.col("a") != F.col("b")).select("b", "a")).distinct()
    )
    roots = live.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    turn = 0
    while not live.isEmpty():
        def ranked(node: Column, turn: int = turn) -> Column:
            return F.struct(F.xxhash64(F.lit(turn), node).alias("rank"), node.alias("node"))

        parents = cut(
            live.groupBy("a").agg(F.min(ranked(F.col("b"))).alias("best"))
            .select(F.col("a").alias("node"),
                    F.least("best", ranked(F.col("a")))["node"].alias("parent"))
        )
        if turn:
            moved = parents.withColumnRenamed("node", "root")
            roots = cut(roots.join(moved, "root", "left").select("node", F.coalesce("parent", "root").alias("root")))
        else:
            roots = parents.withColumnRenamed("parent", "root")
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("new_a"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("new_b"))
        live = cut(
            live.join(of_a, "a").join(of_b, "b").where(F.col("new_a") != F.col("new_b"))
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct()
        )
        turn += 1
    return roots
