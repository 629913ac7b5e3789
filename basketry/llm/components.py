"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.llm.scratch import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang neighbours of every node below the smallest of them; edges are (hi, lo) with hi > lo.

    Both steps are an aggregate and a join on the node, so a node of many edges is no single group:
    the aggregate combines before the shuffle and adaptive execution splits the join.
    """
    if small:  # neighbours below the node, and the node itself
        below = edges.groupBy("hi").agg(F.min("lo").alias("low"))
        joined = edges.join(below, "hi")
        moved = joined.select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
        kept = below.select("hi", F.col("low").alias("lo"))
    else:  # neighbours above the node
        both = edges.select(F.col("hi").alias("at"), F.col("lo").alias("to")).union(edges.select(F.col("lo").alias("at"), F.col("hi").alias("to")))
        lowest = both.groupBy("at").agg(F.min("to").alias("low")).select("at", F.least("at", "low").alias("low"))
        upward = edges.select(F.col("lo").alias("at"), F.col("hi").alias("to"))
        moved = upward.join(lowest, "at").select(F.col("to").alias("hi"), F.col("low").alias("lo"))
        return moved.where(F.col("hi") > F.col("lo")).distinct()
    return moved.where(F.col("hi") > F.col("lo")).union(kept).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node reachable.

    ``edges``: two long columns (a, b); order, repeats and loops do not matter, rows with a null are
    no edges. Each round is written to the shared folder; rounds grow with the logarithm of the
    longest path. No edges give an empty table.
    """
    a, b = edges.columns
    now = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    seen = mark(now)
    while seen[0]:
        now = written(_star(written(_star(now, small=False), "large-star"), small=True), "small-star")
        found = mark(now)
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
