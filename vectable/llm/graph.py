"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vectable.sources.tables import settle


def connected(edges: DataFrame) -> DataFrame:
    """node, root for every node with a link to a smaller one; root is the smallest node of its component.

    ``edges`` has two columns of one orderable type. Alternates two steps until nothing changes: hang
    a node's larger neighbours on its smallest, then a node's smaller neighbours on the smallest of
    them. A node's minimum is an aggregate and its links stay rows, so a hub is never one group in memory.
    """
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    links, before = settle(links), None
    while (now := _digest(links)) != before:
        before = now
        both = links.select("a", "b").union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), F.least("a", "low").alias("low"))
        larger = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = settle(larger.filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), "low")
        smaller = large.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        own = least.select(F.col("u").alias("a"), F.col("low").alias("b"))
        links = settle(smaller.filter("a <> b").union(own).distinct())
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
