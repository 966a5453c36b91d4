"""Connected components of a table of links, by alternating large-star and small-star rounds.

Each round is two map-side-combined groupings and joins on (node, neighbour) pairs; links,
nodes and labels stay in Spark. Every round is written under the checkpoint folder, and only a
count and one yes or no come to the driver: the rounds end when every link leads from a node
with no other link to the centre of its star, which a further round would not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Join each node's neighbours (the larger or the smaller ones) to its smallest neighbour."""
    if large:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    return out.filter("a <> b")


def _only_stars(links: DataFrame) -> bool:
    """Whether each node is either a centre (never ``a``) or in one link only. One map-side-combined grouping."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))).alias("end")).select("end.*")
    each = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return each.agg(F.max((F.col("out") > 0).cast("int") * (F.col("out") - 1 + F.col("into")))).first()[0] in (None, 0)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b: any one ordered type); component: its smallest node.

    Nulls, self-links and repeated links are allowed and mean nothing; without links the result
    is empty.
    """
    links = links.select("a", "b").filter("a <> b")
    now = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _only_stars(now):
        now = stage(_star(_star(now, True), False).distinct(), "links", rows=2 * now.count())
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
