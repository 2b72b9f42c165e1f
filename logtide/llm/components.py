"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.workspace import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are tied to the smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a").where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        .where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, are tied to the smallest."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node with an edge.

    ``edges`` has long columns ``a`` and ``b``. Each round ties nodes to smaller
    ones and is written, so lineage stays short; the number of rounds grows with
    the logarithm of the longest path. Hubs are reduced before the shuffle. Loops
    and repeated edges do no harm.
    """
    current = work.saved(edges.where("a <> b").distinct(), f"{name}-0")
    seen, number = None, 0
    while True:
        number += 1
        current = work.saved(_small_star(_large_star(current)), f"{name}-{number}")
        work.drop(f"{name}-{number - 1}")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    ties = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return ties.union(roots)
