"""Connected components of a graph that is too large for one machine: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

LINKS_A_FILE = 200_000


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, least): v's of each u, and the smallest of them and u. A node's rows may lie in several tasks."""
    # a second grouping column keeps the aggregate's partitioning from the join, so that a hot node's rows can be split
    least = pairs.groupBy("u", F.xxhash64("u")).agg(F.least("u", F.min("v")).alias("least")).select("u", "least")
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of `links` (a, b); no rows for no links.

    Repeated links, links to oneself and either direction are fine; null nodes
    are left out. Rounds are logarithmic in the length of the longest path, and
    each writes its links to the shared folder.
    """
    edges = written(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    # a link is a few bytes: small graphs are kept in few files, larger ones in as many as they need
    parts, known = -(-edges.count() // LINKS_A_FILE) or 1, None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours move to the smallest one
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = written(large.filter("u != v").distinct().coalesce(parts), "links")
        # small star: a node and its smaller neighbours move to the smallest one
        stars = _with_least(large)
        small = stars.select(F.col("v").alias("u"), F.col("least").alias("v")).union(stars.select("u", F.col("least").alias("v")))
        edges = written(small.filter("u != v").distinct().coalesce(parts), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == known:
            tops = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
        known = now
