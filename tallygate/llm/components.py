"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import cut


def _summary(links: DataFrame) -> tuple:
    pair_hash = F.xxhash64("node", "root").cast("decimal(38,0)")
    row = links.agg(F.count("*").alias("n"), F.sum(pair_hash).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint): the smallest node it reaches.

    Roots themselves are left out. Each round hangs every neighbour of a node under the
    smallest one, first upwards and then downwards, so that long chains shorten by a factor
    and a large group ends as one star. Links are at most as many as edges; a node with very
    many links costs its rows once a round, spread over tasks (its minimum is combined
    early, and the join back can be split). Each round's links are stored in the shared
    folder, so a lost executor costs one round. Empty input gives an empty result.
    """
    links = cut(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct()
    )
    seen = _summary(links)
    while seen[0]:
        links = cut(_small_star(_large_star(links)))
        now = _summary(links)
        if now == seen:
            break
        seen = now
    return links


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    lowest = links.groupBy("node").agg(F.min("root").alias("lowest"))
    up = links.select(F.col("root").alias("node"), F.col("node").alias("neighbour"))
    return (
        up.join(lowest, "node", "left")
        .select(
            F.col("neighbour").alias("node"),
            F.coalesce("lowest", "node").alias("root"),
        )
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    lowest = links.groupBy("node").agg(F.min("root").alias("lowest"))
    below = (
        links.join(lowest, "node")
        .where("root <> lowest")
        .select(F.col("root").alias("node"), F.col("lowest").alias("root"))
    )
    return below.union(lowest.select("node", F.col("lowest").alias("root"))).distinct()
