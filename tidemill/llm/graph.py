"""Connected components, and joins that choose a broadcast only by a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import stage

BROADCAST_IDS = 1_000_000


def join_ids(rows: DataFrame, ids: DataFrame, on: list[str], limit: int = BROADCAST_IDS) -> DataFrame:
    """Inner join of wide ``rows`` with a stored table of ids.

    The ids are broadcast when they are at most ``limit`` narrow rows (a count of stored rows, from
    the file footers); otherwise both sides are shuffled.
    """
    few = ids.count() <= limit
    return rows.join(F.broadcast(ids) if few else ids.hint("shuffle_merge"), on)


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them: equal for equal sets of edges."""
    part = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(part)).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for all nodes of ``links (a, b)``; the root is the least of its component.

    Large stars and small stars in turn: each node's larger neighbours, then its smaller ones, move
    to the least of them. Only minima are gathered per node, so a node with very many links is a
    row for each task, and the join that follows is one that adaptive execution splits. Every round is
    written to the shared folder.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(ordered.where("a <> b").distinct(), "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stage(small, "links")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
