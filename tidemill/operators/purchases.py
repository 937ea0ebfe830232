"""Statistics of purchases and the users who made them.

A user may own a large part of all purchases, so purchases are reduced per user, which combines
on the map side, before they meet the users table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mentioning(purchases: DataFrame, text: str) -> DataFrame:
    """Purchases whose date contains ``text`` anywhere."""
    return purchases.where(F.col("order_date").contains(text))


def dated(purchases: DataFrame, prefix: str) -> DataFrame:
    """Purchases whose date starts with ``prefix``; the test reaches the scan."""
    return purchases.where(F.col("order_date").startswith(prefix))


def known_purchase_count(purchases: DataFrame, users: DataFrame) -> DataFrame:
    """Number of joined purchase and user rows.

    Purchases are counted per user first, so the join sees one row per user on each side.
    """
    per_user = purchases.groupBy("user_id").agg(F.count("*").alias("_orders"))
    known = users.groupBy("user_id").agg(F.count("*").alias("_users"))
    return per_user.join(known, "user_id").agg(
        F.coalesce(F.sum(F.col("_orders") * F.col("_users")), F.lit(0)).alias("orders")
    )


def buyer_count(purchases: DataFrame, users: DataFrame) -> DataFrame:
    """Number of users with at least one of the purchases."""
    buyers = purchases.select("user_id").distinct()
    known = users.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    return known.join(buyers, "user_id", "left_semi").agg(F.count("*").alias("buyers"))


def purchases_of(purchases: DataFrame, users: DataFrame, user_id: str | int) -> DataFrame:
    """Purchases of one user who is in the users table.

    The single key would put everything in one task of a shuffle, so the key is filtered on both
    sides and the user's own rows (one in a table of users) decide how often each purchase
    comes out.
    """
    mine = purchases.where(F.col("user_id") == user_id)
    copies = (
        users.where(F.col("user_id") == user_id)
        .groupBy("user_id")
        .agg(F.count("*").alias("_copies"))
    )
    return mine.join(F.broadcast(copies), "user_id").select(
        "order_id",
        "product_id",
        "price",
        "user_id",
        F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_copy"),
    ).drop("_copy")


def price_stats(purchases: DataFrame, users: DataFrame, user_id: str | int | None = None) -> DataFrame:
    """Greatest, least and average price per user found in the users table.

    Repeated users do not change any of the three, so prices are reduced per user before the join.
    """
    if user_id is not None:
        purchases = purchases.where(F.col("user_id") == user_id)
        users = users.where(F.col("user_id") == user_id)
    per_user = purchases.groupBy("user_id").agg(
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.avg("price").alias("avg_price"),
    )
    return per_user.join(users.select("user_id"), "user_id", "left_semi").select(
        "max_price", "min_price", "avg_price", "user_id"
    )
