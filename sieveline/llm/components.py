"""Connected components of a table of links, without the driver seeing any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.sources.scratch import discard, written


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of its component for every node that has a link to another one.

    Each round maps every node to the smallest of itself and its neighbours and keeps the links between different images; the
    images of round after round are composed. The number of links between images falls until none is left. Nodes may be
    of any type with an order; links with a null end count for nothing. Stage tables are written, so a lost executor costs a read.
    """
    edges = written(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b")).distinct(), "links")
    roots = kept = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("image")), "images")
        if roots is None:
            roots = step.withColumnRenamed("image", "root")
        else:
            moved = roots.join(step.withColumnRenamed("node", "root"), "root", "left")
            roots = moved.select("node", F.coalesce("image", "root").alias("root"))
        earlier, roots = kept, written(roots, "roots")
        kept = roots
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("image").alias("x")), "a").join(
            step.select(F.col("node").alias("b"), F.col("image").alias("y")), "b"
        )
        done, edges = edges, written(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).where(F.col("a") != F.col("b")).distinct(), "links")
        discard(done, step, earlier)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
