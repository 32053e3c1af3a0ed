"""Connected components of a table of links, by alternating large and small stars.

Each round groups with map-side minima and joins a node's neighbours to one row per node, so a node with very many
neighbours is a join that adaptive execution may split. The number of rounds follows the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import id_files, split_join
from rollkeep.sources.staging import discard, scope, staged


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """Large star (both directions, larger neighbours move) or small star (smaller neighbours and the node move)."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.union(back) if both else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = split_join(near, least, ["a"])
    moved = joined.where("b > a") if both else joined
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not both:
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is linked with, for every node of links (a, b) that has a link. What is staged
    has as many files as the links' size asks for."""
    files = id_files(links, 1 << 20)
    with scope(links.sparkSession) as own:
        edges, before = staged(links.select("a", "b").where("a <> b").distinct(), "links", files), None
        while True:
            mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
            if mark == before:
                break
            before, old = mark, edges
            edges = staged(_stars(_stars(edges, True), False), "stars", files)
            discard(old)
        roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        return own.keep(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), "roots", files)
