"""Connected components of a link table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmood.llm.shared import shuffled, stored


def _to_smallest(links: DataFrame) -> DataFrame:
    """links with the smallest neighbour of ``u``."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(shuffled(smallest), "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them. All links lead down."""
    near = _to_smallest(links)
    others = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every id in the links ``u``, ``v`` (long): the smallest id reachable.

    Large and small stars in turn until nothing changes; the number of links never grows. Each
    round is a table in the shared folder, and only its checksum reaches the driver.
    """
    links = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links, before = stored(links, name), None
    while True:
        checksum = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if checksum == before or not checksum[0]:
            break
        before = checksum
        links = stored(_small_star(_large_star(links)), name)
    members = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
