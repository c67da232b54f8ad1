"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common


def _least(sym: DataFrame) -> DataFrame:
    """Each node u with its smallest neighbour, joined to its links (u, v, least)."""
    return sym.join(sym.groupBy("u").agg(F.min("v").alias("least")), "u")


def _large_star(links: DataFrame) -> DataFrame:
    sym = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _least(sym).withColumn("least", F.least("u", "least"))
    return near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    near = _least(down)
    out = near.filter(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return out.unionByName(near.select("u", F.col("least").alias("v"))).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether each node has one link, to a node that has none itself."""
    each = links.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    each = each.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    by = each.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return by.filter("out > 1 or (out > 0 and into > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (u, v long): the smallest node reachable.

    Each round points nodes at their smallest neighbour's neighbours (two shuffles on
    the node, with map-side minima, so a hub costs no task more than its share) and is
    written to the shared folder.  It ends when all links are stars around the smallest nodes;
    links between equal nodes are ignored.
    """
    down = links.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
    links = common.cut(down.filter("u <> v").distinct())
    while not _are_stars(links):
        links = common.cut(_small_star(_large_star(links)))
    return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
