"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.session import in_few_tasks, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, its smallest connected node, for every end of an edge.

    Each round joins the edges with the smallest neighbour of their ends, never collecting the neighbours of a node, so
    a node with very many edges is combined on the map side and split by adaptive execution. Rounds end when the edges
    are stars; every round is written, so no lineage grows. Edges with a null end are left out.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = materialize(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    rows = 2 * now.count()  # a round replaces every edge by one or two
    while not _stars(now):
        around = now.union(now.select("v", "u"))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = materialize(in_few_tasks(large, rows), "edges")  # u > v holds
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        now = materialize(in_few_tasks(small.where("u <> v").distinct(), rows), "edges")
    return now.select("u", "v").union(now.select("v", "v")).distinct().toDF("node", "component")


def _stars(edges: DataFrame) -> bool:
    """Whether every node of these distinct edges has one smaller neighbour and no other, or larger ones only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    around = ends.groupBy("node").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return around.where("down > 1 OR (down > 0 AND up > 0)").agg(F.count("*")).first()[0] == 0
