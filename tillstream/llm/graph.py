"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node reachable.

    Stars are enlarged and flattened in turn until only stars are left: the links of a node
    move to its smallest neighbour, so the number of links never grows, and a hot node's
    links are grouped with partial aggregation and joined as the large side of a join
    that adaptive execution can split.  The rounds are logarithmic in the number of nodes.
    Whether a round is needed an aggregate says: no node may have two smaller
    neighbours, or a smaller and a larger one.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    while not _only_stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        links = written(small.where("a <> b").distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _only_stars(links: DataFrame) -> bool:
    ends = F.inline(F.array(*[F.struct(F.col(end).alias("node"), F.lit(up).alias("up")) for end, up in (("a", 1), ("b", 0))]))
    nodes = links.select(ends).groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return not nodes.where("up > 1 or (up = 1 and least = 0)").head(1)
