"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import handover


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """``(id, component_id)`` for every id on an edge of ``edges(a, b)``; the smallest id names it.

    Each step points every vertex at a smaller neighbour of its neighbours; steps grow with the
    logarithm of a component's diameter. A vertex of any degree is a map-side-combined minimum and
    a join that adaptive execution can split; nothing is gathered per component.
    """
    e = handover(edges.where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(max_steps):
        # large star: every larger neighbour of u goes to u's smallest neighbour
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())
        large = handover(large, "large-star")
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        nxt = handover(small, "small-star")
        # done when every vertex points at a root, that is, at a vertex that points nowhere
        if nxt.join(nxt.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty() and \
                nxt.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            e = nxt
            break
        e = nxt
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return stars.unionByName(roots)
