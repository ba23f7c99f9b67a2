"""Connected components of links that live in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _least_neighbour(directed: DataFrame, label: str) -> DataFrame:
    """(u, least): the least of a node and its neighbours. Written out, so that joins see a plain table and hot nodes
    can be split."""
    return stage(directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), label)


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v), root being the least node of its component.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its smaller ones, to its
    least neighbour. The number of rounds grows with the logarithm of the longest chain. Each round is written to the
    shared folder; only two numbers per round reach the driver.
    """
    links = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _mark(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both, "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large")
        least = _least_neighbour(large, "least")
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            joined.select("u", F.col("least").alias("v"))
        )
        links = stage(small.where("u <> v").distinct(), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
