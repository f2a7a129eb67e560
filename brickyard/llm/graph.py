"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """(u long, v long) edges -> (node, component); component is the smallest node reachable.

    Each round hangs the larger neighbours of every node on its smallest
    neighbour, then flattens; the rounds end when all edges lead straight to a
    root, which takes about log(diameter) of them and none for edges that form
    stars already.  A node's neighbours are never gathered: their minimum is a
    map-side combined aggregate and it is joined back.  Every round is cut by a
    reliable checkpoint.  No edges: no rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    now = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .filter("u <> v").distinct().checkpoint())
    while not _stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = small.union(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and no edges of its own below it."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("upper"), F.lit(0).alias("lower"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    sums = ends.groupBy("node").agg(F.sum("upper").alias("upper"), F.max("lower").alias("lower"))
    return sums.filter("upper > 1 or upper = 1 and lower = 1").limit(1).count() == 0
