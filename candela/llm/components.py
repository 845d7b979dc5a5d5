"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node hands its least neighbour to its larger neighbours (large star) or to its smaller ones and itself (small star)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    near = both.join(least, both["a"] == least["u"])
    if large:
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b), root the least node of its component.

    Each round is written to the shared folder. A node with very many links is combined before the shuffle
    and its joins may be split; nothing is gathered per node. No links, no rows.
    """
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    seen = state(edges)
    while seen[0]:
        edges = stored(_star(_star(edges, large=True), large=False), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
