"""Connected components of a table of links, by rounds of star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealreports.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that can be reached, for each node that has a link.

    ``links`` has two long columns ``a`` and ``b``. Rounds hang each node's larger neighbours, then its smaller
    ones, on the smallest of them (large star and small star) until every node hangs on its component's smallest.
    Partial minima keep hot nodes cheap; each round is written to the shared folder.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b"), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _hung(both, both.where("b > a"))
        down = large.where("a > b").distinct()
        edges = written(_hung(down, down).where("a > b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.union(roots)


def _hung(all_links: DataFrame, moved: DataFrame) -> DataFrame:
    """Links from each moved neighbour, and from the node itself, to the smallest node around it."""
    smallest = all_links.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    again = moved.join(smallest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return again.union(smallest.select("a", F.col("low").alias("b")))
