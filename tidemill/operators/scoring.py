"""Recommendations from item similarities: score what a user has not got by what the user has."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import scans
from tidemill.operators.ranking import top_per_key
from tidemill.operators.skew import ROWS_PER_SLICE, fits_broadcast, heavy_in_table
from tidemill.session import stage

TERMS_PER_TASK = 200_000_000
# All pairs of a hundred items.
BROADCAST_ROWS = 10_000
# Rows that the grid of users and items may send, and similarities that every task may read instead.
SENT_ROWS, READ_ROWS = 1_000_000, 400_000_000
TERMS_HELD = 8_000_000


def user_items(prefs: DataFrame) -> DataFrame:
    """Summed preference per user and item."""
    return (
        prefs.dropna(subset=["user_id", "item_id", "pref"])
        .groupBy("user_id", "item_id")
        .agg(F.sum("pref").alias("total"))
    )


def unseen_scores(
    sims: DataFrame,
    held: DataFrame,
    terms_per_task: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Sum of preference times similarity for every item the user does not hold.

    ``held`` is a stored table with one row ``(user_id, item_id, total)`` per user and item, and
    ``sims`` one of similarities. There are as many terms as pairs of a held row and a similarity
    of its item, which may be far more than rows in either table. With up to
    ``broadcast_rows`` similarities a user has few sums, which the task that reads the user's rows
    can keep; with more, the work is cut so that terms are not shuffled at all.
    """
    held = held.select("user_id", "item_id", "total")
    edges = sims.select(F.col("item_id1").alias("item_id"), "item_id2", "similar")
    if fits_broadcast(edges, max_rows=broadcast_rows):
        return _scores_by_broadcast(edges, held)
    return _scores_by_grid(edges, held, terms_per_task or TERMS_PER_TASK)


def _scores_by_broadcast(edges: DataFrame, held: DataFrame) -> DataFrame:
    """Terms start to add up where the held rows are read.

    What a user holds goes into the same sums as a mark, which spares a second shuffle.
    """
    terms = held.join(F.broadcast(edges), "item_id").select(
        "user_id",
        F.col("item_id2").alias("item_id"),
        (F.col("total") * F.col("similar")).alias("term"),
        F.lit(False).alias("is_held"),
    )
    marks = held.select("user_id", "item_id", F.lit(0.0).alias("term"), F.lit(True).alias("is_held"))
    return (
        terms.unionByName(marks)
        .groupBy("user_id", "item_id")
        .agg(F.sum("term").alias("pref"), F.max("is_held").alias("is_held"))
        .where(~F.col("is_held"))
        .select("user_id", "item_id", "pref")
    )


def count_terms(edges: DataFrame, held: DataFrame) -> int:
    """Pairs of a held row and a similarity of its item."""
    per_item = (
        held.groupBy("item_id")
        .agg(F.count("*").alias("users"))
        .join(edges.groupBy("item_id").agg(F.count("*").alias("neighbours")), "item_id")
    )
    return per_item.agg(F.sum(F.col("users") * F.col("neighbours"))).first()[0] or 0


def grid_size(edges: DataFrame, held: DataFrame, terms_per_task: int) -> tuple[int, int]:
    """How many shards of users and blocks of recommended items to score in.

    Enough cells for the number of terms, in the proportion that moves the fewest rows: every
    held row goes to all blocks of its shard, every similarity to all shards of its block.
    """
    terms = count_terms(edges, held)
    cores = held.sparkSession.sparkContext.defaultParallelism
    cells = max(cores, math.ceil(terms / terms_per_task))
    ratio = edges.count() / max(held.count(), 1)
    blocks = min(max(round(math.sqrt(cells * ratio)), 1), cells)
    return math.ceil(cells / blocks), blocks


def _scores_by_grid(edges: DataFrame, held: DataFrame, terms_per_task: int) -> DataFrame:
    """Cut users into shards and recommended items into blocks, and score each cell in one task.

    All terms of a user and an item meet in one cell, so they are made, added up and rid of the
    held items there, without a shuffle of terms. Users are hashed, so the rows of a popular
    item spread over all shards; the rows of a busy user, at most one per item, over its blocks.
    """
    shards, blocks = grid_size(edges, held, terms_per_task)
    cell = (F.col("shard") * blocks + F.col("block")).cast("int").alias("cell")
    shard = F.pmod(F.xxhash64("user_id"), F.lit(shards)).alias("shard")

    def block(item: str) -> Column:
        return F.pmod(F.xxhash64(item), F.lit(blocks)).alias("block")

    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def placed(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(cell, *columns).repartitionById(shards * blocks, "cell")

    rows = placed(held.select("*", shard, every(blocks, "block")), *held.columns)
    links = placed(edges.select("*", block("item_id2"), every(shards, "shard")), *edges.columns)
    owned = placed(held.select("*", shard, block("item_id")), "user_id", "item_id")
    scores = (
        rows.join(links, ["cell", "item_id"])
        .groupBy("cell", "user_id", F.col("item_id2").alias("item_id"))
        .agg(F.sum(F.col("total") * F.col("similar")).alias("pref"))
    )
    return scores.join(owned, ["cell", "user_id", "item_id"], "left_anti").drop("cell")


def without_held(scores: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of ``scores`` whose item the user does not hold."""
    return scores.join(held.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def _stored(prefs: DataFrame) -> DataFrame:
    # A user's items side by side let most of a user's terms add up before the shuffle.
    return stage(user_items(prefs), "held", together="user_id")


def recommend_top(
    sims: DataFrame,
    prefs: DataFrame,
    n: int = 30,
    terms_per_task: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    sent_rows: int = SENT_ROWS,
    terms_held: int = TERMS_HELD,
) -> DataFrame:
    """The ``n`` best unseen items per user, as ``(user_id, item_id, pref, rank)``.

    Where a grid would send more than ``sent_rows`` rows, and unless one of ``terms_per_task`` is asked for, each task holds some users and
    reads all similarities (:func:`scans.best_unseen`), so neither held rows nor similarities are repeated on disk.
    """
    held = _stored(prefs)
    edges = sims.select(F.col("item_id1").alias("item_id"), "item_id2", "similar")
    scores = None
    if terms_per_task is None and not fits_broadcast(edges, max_rows=broadcast_rows):
        rows, links = held.count(), edges.count()
        shards, blocks = grid_size(edges, held, TERMS_PER_TASK)
        if rows * (blocks + 1) + links * shards > sent_rows and links <= READ_ROWS:
            cores = held.sparkSession.sparkContext.defaultParallelism
            tasks = max(2 * cores, math.ceil(count_terms(edges, held) / terms_held))
            if tasks <= scans.MOST_TASKS:
                scores = scans.best_unseen(edges, held, n, tasks, lambda df, key: heavy_in_table(df, key, ROWS_PER_SLICE))
    if scores is None:
        scores = unseen_scores(sims, held, terms_per_task, broadcast_rows)
    return top_per_key(scores, "user_id", "pref", "item_id", n)


def recommend_all(sims: DataFrame, prefs: DataFrame, **sizes) -> DataFrame:
    """All unseen items with their scores, ordered by user and ascending score."""
    scores = unseen_scores(sims, _stored(prefs), **sizes)
    return scores.orderBy("user_id", "pref", "item_id")
