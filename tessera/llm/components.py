"""Connected components by alternating large-star and small-star rounds.

Edges and labels stay distributed; each round is written to the shared folder,
so lineage stays short and a lost executor costs a reread.  Minima are
pre-aggregated per task, and a join with them reads two plain tables, which
lets Spark split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row.n, row.h


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of
    ``edges(u, v)``.  Loops and repeated edges may occur; null ends drop out."""
    hi, lo = F.greatest("u", "v"), F.least("u", "v")
    e = stage(edges.where(F.col("u") != F.col("v")).select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    before = _state(e)
    while before[0]:
        # large star: the larger neighbours of u move to u's smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "minima")
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u != v").distinct(), "edges")
        # small star: u and its smaller neighbours move to the smallest of them
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
