"""Joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.frequent import keys_above
from tidemill.session import stage

ROWS_PER_SLICE = 2_000_000
BROADCAST_KEYS = 1_000_000


def heavy_keys(df: DataFrame, key: str, rows_per_slice: int) -> DataFrame:
    """``(_heavy_key, _slices)`` of the keys with more than ``rows_per_slice`` rows.

    All of them: there are at most ``rows / rows_per_slice``. The count combines on the map side, so a hot
    key costs one counter per task.
    """
    wanted = F.ceil(F.col("_rows") / F.lit(rows_per_slice))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_heavy_key"))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rows_per_slice)
        .select("_heavy_key", wanted.cast("bigint").alias("_slices"))
    )


def with_slices(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """Add ``_slices``, the number of parts the row's key is cut into (1 for most).

    ``heavy`` is broadcast up to :data:`BROADCAST_KEYS` counted rows; a longer list is joined by
    shuffle, where adaptive execution splits the partitions of hot keys.
    """
    few = heavy.count() <= BROADCAST_KEYS
    keys = F.broadcast(heavy) if few else heavy.hint("shuffle_merge")
    return df.join(keys, F.col(key) == F.col("_heavy_key"), "left").select(
        *df.columns, F.coalesce("_slices", F.lit(1).cast("bigint")).alias("_slices")
    )


def heavy_in_table(df: DataFrame, key: str, rows_per_slice: int) -> DataFrame | None:
    """:func:`heavy_keys` of a stored table, found now; None when there are none.

    Knowing that no key is heavy leaves the join a plain one. Counting the rows of a table takes
    its file footers only, and settles the question for tables no larger than one slice. In larger
    ones hash buckets of the keys are counted and only keys of large buckets are counted singly, so a
    nearly unique key is not shuffled to learn that it is one. A table is cut into 100,000 slices
    at most: keys below that share of it are not heavy.
    """
    rows = df.count()
    if rows <= rows_per_slice:
        return None
    keys = keys_above(df, key, rows_per_slice, rows)
    if keys is None:
        return None
    wanted = F.ceil(F.col("n") / F.lit(rows_per_slice)).cast("bigint")
    keys = stage(keys.select(F.col("key").alias("_heavy_key"), wanted.alias("_slices")), "heavy-keys")
    return None if keys.isEmpty() else keys


def sliced_join(
    big: DataFrame, small: DataFrame, key: str, heavy: DataFrame | None, how: str = "inner"
) -> DataFrame:
    """Equi-join on ``key``, inner or left, where the ``heavy`` keys own many rows of ``big``.

    A heavy key's rows are spread over slices by the hash of the whole row, and the rows of
    ``small`` with that key are repeated once per slice. Rows of ``big`` without a key match
    nothing and are spread by the hash itself.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"sliced_join does inner and left joins, not {how!r}")
    if heavy is None:
        return big.join(small, key, how)
    spread = F.xxhash64(*big.columns)
    sliced = with_slices(big, key, heavy).withColumn(
        "_slice", F.when(F.col(key).isNull(), spread).otherwise(F.pmod(spread, "_slices"))
    )
    copies = with_slices(small, key, heavy).withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1))
    )
    return sliced.drop("_slices").join(copies.drop("_slices"), [key, "_slice"], how).drop("_slice")


def skewed_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """:func:`sliced_join` with the heavy keys counted and stored first."""
    return sliced_join(big, small, key, stage(heavy_keys(big, key, rows_per_slice), "heavy-keys"), how)


def fits_broadcast(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> bool:
    """Whether ``df`` is small enough to send to every executor.

    Reads at most ``max_rows + 1`` rows to find out.
    """
    size = (
        df.limit(max_rows + 1)
        .agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b"))
        .first()
    )
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def lookup(
    df: DataFrame, dim: DataFrame, key: str, how: str = "left", costly: bool = False, **limits
) -> DataFrame:
    """Add the columns of a dimension by key.

    The dimension is broadcast when its measured size allows, else joined by shuffle with heavy
    keys sliced. That reads ``df`` twice; one that is ``costly`` to compute is stored first.
    """
    if fits_broadcast(dim, **limits):
        return df.join(F.broadcast(dim), key, how)
    rows = stage(df, "lookup") if costly else df
    return skewed_join(rows, dim, key, how)
