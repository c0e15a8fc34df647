"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapmart.session import freeze


def _settled(links: DataFrame) -> bool:
    """Whether every node points to one other, and none to a node that points on."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("met"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("met").alias("met"))
    return ends.agg(F.count_if(F.expr("out > 1 OR out = 1 AND met = 1"))).first()[0] == 0


def _starred(links: DataFrame, small: bool) -> DataFrame:
    """Point neighbours to the least of their neighbourhood.

    With ``small`` every node tells its smaller neighbours, otherwise its larger ones. The least
    is added up before the shuffle, and the join back can be split where a node has very many
    links.
    """
    if small:
        seen = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        seen = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = seen.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    told = seen.join(least, "u")
    if small:
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        moved = told.select(F.col("v").alias("a"), F.col("m").alias("b")).union(own)
    else:
        moved = told.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, frozen: bool = False) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``): the least node reachable.

    Alternates large-star and small-star steps until every node points to its component's least,
    which takes a number of rounds that grows with the logarithm of the nodes. Every round is
    written to shared storage. ``frozen`` links are there already, without repeats.
    """
    given = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = given if frozen else freeze(given.distinct(), "links")
    while not _settled(links):
        links = freeze(_starred(_starred(links, small=False), small=True), "links")
    pointed = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pointed.union(roots)
