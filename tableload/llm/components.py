"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableload.session import shared_dir


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u long, v long); root is the least node.
    Self-loops keep lone nodes.  State is checkpointed in the shared folder each round."""
    shared_dir(edges.sparkSession)
    current = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .dropDuplicates().checkpoint()
    mark = None
    while True:
        # the mark of an unchanged edge set is unchanged: every node then points at its root
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        current = _small_star(_large_star(current).dropDuplicates()).filter("u <> v").dropDuplicates().checkpoint()
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root"))
    loops = edges.filter("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    pointed = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pointed.union(roots).union(loops).groupBy("node").agg(F.min("root").alias("root"))
