"""Connected components of an edge table by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.session import cut


#: Edges that one task takes at least, so that small graphs don't make many tasks and files a round.
EDGES = 50_000


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s"), F.sum(F.xxhash64("v", "u") % 999_983).alias("t")).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in edges (u, v); the component is its smallest id.

    Loops and repeated edges do no harm; no edges give no rows. Each round halves the depth of the trees, and every join is on a key
    whose other side has one row a key, so a hot centre is split like any skewed join.
    """
    e = cut(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while before != (now := _mark(e)):
        before = now
        # a round makes no more edges than twice those it has, so their number bounds its tasks
        tasks = max(1, -(-now[0] // EDGES))
        e = e.coalesce(tasks)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        e = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
