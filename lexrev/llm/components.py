"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexrev.llm.common import join_totals
from lexrev.session import cut_lineage

MAX_ROUNDS = 60


def _pairs_to_smallest(both: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest member of u's neighbourhood, u included."""
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return join_totals(both, low, ["u"])


def components(links: DataFrame) -> DataFrame:
    """Smallest node of each node's component: columns node, root; only nodes that have a link.

    ``links(a, b)`` are undirected. Each round links every larger neighbour of a node to the smallest
    one, then every node's smaller neighbours to the smallest one; the number of rounds grows with the
    logarithm of the longest chain. Minima are aggregated partially and joined back, so that no
    neighbourhood is gathered. Each round's table is written to the checkpoint folder.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_pairs_to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: rows point from the larger node to the smaller one
        large = cut_lineage(large, "links")
        low = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")), "links")
        pulled = large.join(low, "u")
        edges = cut_lineage(pulled.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                            .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
