"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the smallest node it can reach.

    Alternates two star operations until the links no longer change: every node
    hands its larger neighbours, then its smaller ones, to the smallest node it
    sees.  The number of rounds grows with the logarithm of the longest chain.
    Nothing but two sums per round reaches the driver; a hub's links are folded
    by `min` before they are shuffled and its join is one that Spark can split.
    Null ends are no links; links of a node to itself keep it as its own root.
    """
    links = stored(links.select("a", "b"), "links")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).dropna().distinct()
    edges = links.dropna().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        edges = _star(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        edges = stored(_star(edges, larger=False), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    # At the end every node is linked to its root and to nothing else.
    return nodes.join(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links (node, smaller node) after one step.  `edges`: every link twice if `larger`, else from the larger end only."""
    least = edges.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"))
    if larger:
        least = least.withColumn("m", F.least("hub", "m"))
        moved = edges.join(least, edges["a"] == least["hub"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = edges.join(least, edges["a"] == least["hub"]).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select(F.col("hub").alias("a"), F.col("m").alias("b")))
    return moved.filter("a != b").distinct()
