"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round hangs every node's larger neighbours on its smallest one, then its
    smaller neighbours; the links end as stars. A round is a few grouped joins
    over the links, written to the shared folder; a node with many links is one
    row per link, never one group in a task. No links give no rows.
    """
    edges = written(links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a <> b").distinct(), "links")
    before, now = None, _state(edges)
    while now != before:
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        edges = (both.filter("b > a").join(least, "a").selectExpr("b AS a", "m AS b").filter("a <> b").distinct())
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        hung = edges.join(least, "a").selectExpr("greatest(b, m) AS a", "least(b, m) AS b").filter("a <> b")
        edges = written(hung.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
        before, now = now, _state(edges)
    return edges.selectExpr("a AS node", "b AS root").unionByName(edges.selectExpr("b AS node", "b AS root").distinct())
