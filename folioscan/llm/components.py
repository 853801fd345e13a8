"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.sources.workspace import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)``; ``label`` is the smallest node it reaches.

    Each round hangs the larger neighbours of a node, then all its neighbours, below the smallest one;
    a few rounds leave stars. Edges are checkpointed per round, and only their number and a checksum come
    to the driver. A node's neighbours are never collected; minima are stored before they are joined, so
    that each join is of two shuffles, which Spark splits at a node with very many neighbours. Loops and repeated edges do no harm; a null
    end drops the edge; no edges give no rows.
    """
    ordered = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current, before = checkpointed(ordered.distinct()), None
    while (mark := _mark(current)) != before and mark[0]:
        before = mark
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        lowest = checkpointed(lowest)
        large = both.filter(F.col("b") > F.col("a")).join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.distinct())
        least = checkpointed(large.groupBy("a").agg(F.min("b").alias("m")))
        hung = large.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = least.select("a", F.col("m").alias("b"))
        current = checkpointed(stars.unionByName(hung).distinct())
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(centres)


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
