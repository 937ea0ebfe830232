"""Alternating least squares for many settings in the same passes, where all ratings are of a few items.

A user's ratings fit one row of a matrix with a column for each item. Users are packed into blocks of such rows once;
an iteration reads the blocks, solves the users of a block and adds them to the items' normal equations on the spot. Only these
sums, whose size hangs on the items and not on the users, leave a task, and users' factors are neither stored nor sent.

The equations are those of Spark ML's solver: a regularization that grows with the number of ratings (implicit: of those above
zero), confidence ``1 + alpha * |rating|``, users first drawn as unit vectors, items solved before users in every iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import scratch, stage

# Columns of a user's row, and so of the sums that a task sends for each setting.
MOST_ITEMS = 64
BLOCK_USERS = 1_024

_BLOCK = "users binary, n binary, mean binary, spread double, size binary, liked binary, liked_total binary"
_SUMS = "setting int, sums binary"
_FACTORS = "setting int, factors binary"
_ERRORS = "setting int, error double, ratings double"


class Setting(NamedTuple):
    mode: str
    rank: int
    reg: float
    alpha: float | None


class Block(NamedTuple):
    """Some users, and for each and each item how many ratings there are, their mean, the sum of their sizes,
    and number and sum of those above zero; ``spread`` is the sum of all squared deviations from the means."""

    users: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    spread: float
    size: np.ndarray
    liked: np.ndarray
    liked_total: np.ndarray

    def equations(self, mode: str, alpha: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of the squared errors, weighted values, and the ratings that count for the regularization."""
        if mode == "explicit":
            return self.n, self.n * self.mean, self.n
        return 1 + alpha * self.size, self.liked + alpha * self.liked_total, self.liked


def _packed(items: int):
    """Rows ``user_code, item_code, rating`` in the order of users as rows of :data:`_BLOCK`."""
    names = [field.split()[0] for field in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        sums = np.zeros((6, BLOCK_USERS * items))

        def block() -> pa.RecordBatch:
            n, total, squares, size, liked, liked_total = sums[:, : len(held) * items]
            mean = total / np.maximum(n, 1)
            spread = float(np.maximum(squares - total * mean, 0).sum())
            rest = [None] * 3 if (liked == n).all() else [a.tobytes() for a in (size, liked, liked_total)]
            values = [np.array(held, dtype=np.int64).tobytes(), n.tobytes(), mean.tobytes(), spread, *rest]
            kinds = [pa.float64() if name == "spread" else pa.binary() for name in names]
            return pa.record_batch([pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)], names)

        for batch in batches:
            users, codes, ratings = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            at = 0
            while at < len(users):
                fresh = np.empty(len(users) - at, dtype=bool)
                fresh[0] = not held or users[at] != held[-1]
                fresh[1:] = users[at + 1 :] != users[at:-1]
                row = len(held) - 1 + np.cumsum(fresh)
                end = int(np.searchsorted(row, BLOCK_USERS))
                if end:
                    cell, r = row[:end] * items + codes[at : at + end], ratings[at : at + end]
                    liked = r > 0
                    for k, values in enumerate((np.ones(end), r, r * r, np.abs(r), liked, np.where(liked, r, 0))):
                        found = np.bincount(cell, values)
                        sums[k, : len(found)] += found
                    held += users[at : at + end][fresh[:end]].tolist()
                    at += end
                if at < len(users):
                    yield block()
                    held.clear()
                    sums[:] = 0
        if held:
            yield block()

    return run


def _unpacked(batches: Iterator[pa.RecordBatch], items: int) -> Iterator[Block]:
    for batch in batches:
        for row in batch.to_pylist():
            n, mean = (np.frombuffer(row[c]).reshape(-1, items) for c in ("n", "mean"))
            if row["size"] is None:
                rest = [n * mean, n, n * mean]
            else:
                rest = [np.frombuffer(row[c]).reshape(-1, items) for c in ("size", "liked", "liked_total")]
            yield Block(np.frombuffer(row["users"], dtype=np.int64), n, mean, row["spread"], *rest)


def drawn(users: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Random unit vectors that follow from a user's code and the seed, wherever the user is."""
    x = users.astype(np.uint64)[:, None] * np.uint64(1 << 16) + np.arange(2 * rank, dtype=np.uint64)
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1342543DE82EF95 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    share = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53
    normal = np.sqrt(-2 * np.log1p(-share[:, :rank])) * np.cos(2 * np.pi * share[:, rank:])
    return normal / np.maximum(np.linalg.norm(normal, axis=1), 1e-30)[:, None]


def _least_squares(left: np.ndarray, right: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Solutions of stacked equations with ``ridge`` (a row each) added to the diagonals."""
    at = np.arange(left.shape[1])
    left[:, at, at] += ridge
    return np.linalg.solve(left, right[:, :, None])[:, :, 0]


def solved_users(weight: np.ndarray, wanted: np.ndarray, counted: np.ndarray, factors: np.ndarray, reg: float) -> np.ndarray:
    """Users' factors given the items' ones, as rows ``x``.

    With more factors than items a user is a sum of item factors: ``x`` are its coefficients, one for each item, and the
    equations as small; otherwise ``x`` are the factors. :func:`basis` turns both into factors.
    """
    ridge = reg * counted.sum(axis=1, keepdims=True)
    ridge[ridge == 0] = 1  # nothing is wanted of such a user: zeros
    items, rank = factors.shape
    if rank <= items:
        outer = (factors[:, :, None] * factors[:, None, :]).reshape(items, -1)
        return _least_squares((weight @ outer).reshape(-1, rank, rank), wanted @ factors, ridge)
    has = weight > 0
    divisor = np.where(has, weight, 1)
    left = (factors @ factors.T) * (has[:, :, None] & has[:, None, :])
    return _least_squares(left, wanted / divisor, np.where(has, ridge / divisor, 1))


def basis(factors: np.ndarray) -> np.ndarray | None:
    """What the rows of :func:`solved_users` are multiplied by to get factors; None when they are factors."""
    return factors if factors.shape[1] > factors.shape[0] else None


def _added(settings: list[Setting], factors: list[np.ndarray] | None, items: int, seed: int):
    """A task's sums for the items' equations, a row for each setting. Without ``factors`` users are drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        # Drawn users do not depend on the regularization.
        alike = {k: next(i for i, t in enumerate(settings) if t._replace(reg=s.reg) == s) for k, s in enumerate(settings)}
        for block in _unpacked(batches, items):
            for k, s in enumerate(settings):
                if factors is None and alike[k] != k:
                    continue
                weight, wanted, counted = block.equations(s.mode, s.alpha)
                if factors is None:
                    x = drawn(block.users, s.rank, seed)
                else:
                    x = solved_users(weight, wanted, counted, factors[k], s.reg)
                size = x.shape[1]
                own = sums.setdefault(k, np.zeros((items, size * size + size + 1)))
                for item, root in enumerate(np.sqrt(weight).T):
                    scaled = x * root[:, None]
                    own[item, : size * size] += (scaled.T @ scaled).ravel()
                own[:, size * size : -1] += wanted.T @ x
                own[:, -1] += counted.sum(axis=0)
        if not sums:
            return
        found = [sums[alike[k] if factors is None else k].tobytes() for k in range(len(settings))]
        yield pa.record_batch([pa.array(range(len(settings)), pa.int32()), pa.array(found, pa.binary())], ["setting", "sums"])

    return run


def _solved_items(settings: list[Setting], factors: list[np.ndarray] | None, items: int):
    """Item factors of a setting from the sums of all tasks."""

    def run(table: pa.Table) -> pa.Table:
        k = table["setting"][0].as_py()
        total = sum(np.frombuffer(own.as_buffer()) for own in table["sums"]).reshape(items, -1)
        size = round((total.shape[1] - 0.75) ** 0.5 - 0.5)
        left, right = total[:, : size * size].reshape(items, size, size).copy(), total[:, size * size : -1]
        turned = None if factors is None else basis(factors[k])
        if turned is not None:
            left, right = turned.T @ left @ turned, right @ turned
        ridge = settings[k].reg * total[:, -1:]
        ridge[ridge == 0] = 1
        found = _least_squares(left, right, ridge)
        return pa.table({"setting": pa.array([k], pa.int32()), "factors": pa.array([found.tobytes()], pa.binary())})

    return run


def _missed(settings: list[Setting], factors: list[np.ndarray], items: int):
    """A task's squared errors and ratings for each setting, its users solved for the last items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors, ratings = np.zeros(len(settings)), 0.0
        for block in _unpacked(batches, items):
            ratings += block.n.sum()
            for k, s in enumerate(settings):
                x = solved_users(*block.equations(s.mode, s.alpha), factors[k], s.reg)
                turned = basis(factors[k])
                predicted = (x if turned is None else x @ turned) @ factors[k].T
                errors[k] += (block.n * (block.mean - predicted) ** 2).sum() + block.spread
        columns = [pa.array(range(len(settings)), pa.int32()), pa.array(errors), pa.array([ratings] * len(settings))]
        yield pa.record_batch(columns, ["setting", "error", "ratings"])

    return run


def mean_squared_errors(
    ratings: DataFrame, items: int, settings: list[Setting], iterations: int, seed: int = 7
) -> list[float]:
    """Error on the known ratings ``(user_code, item_code, rating)`` of a fit of each setting, item codes from 0 to ``items - 1``."""
    spark = ratings.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    with scratch(spark):
        rows = ratings.select("user_code", "item_code", F.col("rating").cast("double").alias("rating"))
        rows = rows.repartition(tasks, "user_code").sortWithinPartitions("user_code")
        blocks = stage(rows.mapInArrow(_packed(items), _BLOCK), "blocks").coalesce(tasks)
        factors = None
        for _ in range(iterations):
            sums = blocks.mapInArrow(_added(settings, factors, items, seed), _SUMS)
            solved = sums.groupBy("setting").applyInArrow(_solved_items(settings, factors, items), _FACTORS)
            found = {row["setting"]: bytes(row["factors"]) for row in solved.collect()}  # a row for each setting
            if not found:
                return [float("nan")] * len(settings)
            factors = [np.frombuffer(found[k]).reshape(items, s.rank) for k, s in enumerate(settings)]
        missed = blocks.mapInArrow(_missed(settings, factors, items), _ERRORS)
        total = missed.groupBy("setting").agg((F.sum("error") / F.sum("ratings")).alias("mse"))
        errors = {row["setting"]: row["mse"] for row in total.collect()}  # a row for each setting
        return [errors[k] for k in range(len(settings))]
