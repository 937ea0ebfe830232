"""Dense integer ids for string keys, and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import stage
from tidemill.operators.skew import ROWS_PER_SLICE, heavy_in_table, skewed_join, sliced_join

# Keys are numbered by the hex digits of their md5: that spreads any key set evenly, so buckets
# (one per leading digits) have near-equal size and can be numbered apart. There are as many digits
# as keep a bucket small; they do not change the numbers.
LEAST_DIGITS, KEYS_PER_BUCKET = 3, 500_000


def bucket_digits(keys: int, per_bucket: int = KEYS_PER_BUCKET) -> int:
    digits = LEAST_DIGITS
    while keys > per_bucket * 16**digits:
        digits += 1
    return digits


def dense_ids(df: DataFrame, key: str, code: str = "code", per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """One row ``(key, code)`` per distinct key, codes 0, 1, 2, ... without gaps.

    The same keys always get the same codes. No single task sees all keys: each bucket numbers
    its own, some ``per_bucket`` of them, on top of the sizes of the buckets before it. The distinct keys are stored, since they are counted
    first and read twice.
    """
    hashed = df.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_hash", F.md5(F.col(key).cast("string")))
    keys = stage(hashed, "keys")
    keys = keys.withColumn("_bucket", F.substring("_hash", 1, bucket_digits(keys.count(), per_bucket)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keys.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", key)
    return (
        keys.withColumn("_at", F.row_number().over(inside))
        .join(F.broadcast(starts), "_bucket")
        .select(key, (F.col("_start") + F.col("_at") - 1).alias(code))
    )


def encode(
    df: DataFrame, ids: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add the code of ``key`` to a stored table; rows whose key has none are dropped."""
    return sliced_join(df, ids, key, heavy_in_table(df, key, rows_per_slice))


def decode(
    df: DataFrame, ids: DataFrame, code: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add the key behind ``code``; an unknown code gives no row."""
    return skewed_join(df, ids, code, rows_per_slice=rows_per_slice)
