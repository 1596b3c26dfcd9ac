"""Connected components of a link table, without any node's links in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.llm.common import lookup
from hearthscore.session import stage_table


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links u > v."""
    both = stage_table(
        links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links"
    )
    low = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
    large = lookup(both, low, ["u"], "inner").where("v > u")
    large = stage_table(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
    low = _least_neighbour(large)
    small = lookup(large, low, ["u"], "inner").where("v != m")
    small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select("u", F.col("m").alias("v"))
    return stage_table(small.unionByName(own).where("u != v").distinct(), "links")


def _state(links: DataFrame):
    return links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()


def components(links: DataFrame) -> DataFrame:
    """Columns ``u``, ``v`` (links between different nodes) to ``node``, ``root``.

    ``root`` is the smallest node reachable; nodes without a link do not appear.
    Alternates large-star and small-star steps until every node points at its
    root.  Minima combine in the map tasks and a hub's links are spread by
    ``lookup``.  Repeated links and links in both directions are harmless; an
    empty table gives an empty result.
    """
    links = links.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = stage_table(links.distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before, links = now, _round(links)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
