"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.session import settle


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free sum of the links: equal marks mean that a round changed nothing."""
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return tuple(row)


def _star(edges: DataFrame) -> DataFrame:
    """Hang the neighbours ``v`` of each ``u`` on the least node of its surroundings.

    The minima are stored, so that both sides of the join are plain exchanges, which Spark can split
    where one node has very many links.
    """
    least = settle(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "minima")
    return edges.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``u``, ``v``); the root is the least node.

    Each round is written to the shared folder, so a lost executor repeats one round at most.  Links
    of a node to itself and repeated links do no harm; no links give no rows.
    """
    edges = settle(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, "links")
        small = _star(large)
        hung = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(hung.unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
