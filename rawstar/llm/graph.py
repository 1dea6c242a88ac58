"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.base import stage


def _least(pairs: DataFrame) -> DataFrame:
    """u, m: the least of u and its partners. Partial sums keep a hub from meeting in one task."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """`links` has u, v (long); returns u, root: the least node that u reaches, root itself left out.

    Large and small stars in turn: every node passes its larger partners, then its smaller ones, to
    the least node it knows, until nothing changes. That takes a number of rounds that grows with
    the logarithm of the number of nodes, also for long chains.
    """
    edges = links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = stage(edges.distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: partners above u go to the least partner of u
        large = (
            both.join(_least(both), "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        large = stage(large, "large-star")
        # small star: partners below u, and u, go to the least partner of u
        low = _least(large)
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        small = stage(small, "small-star")
        # done when every node has one partner and no partner has one above itself
        tops = small.groupBy("u").count().filter("count > 1").select("u")
        inner = small.select("u").join(small.select(F.col("v").alias("u")), "u", "left_semi")
        if tops.isEmpty() and inner.isEmpty():
            return small.select("u", F.col("v").alias("root"))
        edges = small
