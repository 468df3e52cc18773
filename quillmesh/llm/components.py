"""Connected components of a link table by alternating large and small stars.

Each round rewires every node to the smallest node it sees (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014) until nothing changes.
Every step is an aggregation by node and a join; no component is ever gathered
in one task or on the driver, and each round is a written table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import keep


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u goes to the smallest of u's neighbourhood."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours go to the smallest of them; u > v in every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, done: Iterable[DataFrame] = ()) -> DataFrame:
    """node, root for every linked node but the roots; links has columns a, b.

    The result is a kept table. `done`: kept tables that nothing needs after the links.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = keep(edges, "links", done)
    before = _state(edges)
    while before[0]:
        edges = keep(_small_star(_large_star(edges)), "stars", [edges])
        now = _state(edges)
        if now == before:
            break
        before = now
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out.kept_at = edges.kept_at
    return out
