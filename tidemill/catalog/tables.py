"""The driver's tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.skew import ROWS_PER_SLICE, heavy_in_table, sliced_join
from tidemill.session import new_folder


def registrar(queries: dict, oracles: dict):
    """Decorator factory: ``@query(sql)`` files a function and the SQL that checks it."""

    def query(sql: str | None = None):
        def register(run):
            queries[run.__name__] = run
            if sql is not None:
                oracles[run.__name__] = sql
            return run

        return register

    return query


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as people: segment for gender, balance for height."""
    return table(spark, folder, "customer").select(
        text("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_acctbal").alias("height"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as purchases, dates unpadded. Keys stay numbers, so filters on them reach the scan."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-M-d").alias("order_date"),
        (F.col("o_orderkey") % 10 + 1).cast("int").alias("product_id"),
        F.floor("o_totalprice").cast("int").alias("price"),
        F.col("o_custkey").alias("user_id"),
    )


PURCHASES_SQL = """(
SELECT o_orderkey AS order_id,
       year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) AS order_date,
       CAST(o_orderkey % 10 + 1 AS INTEGER) AS product_id,
       CAST(floor(o_totalprice) AS INTEGER) AS price,
       o_custkey AS user_id
FROM orders)"""

USERS_SQL = "(SELECT c_custkey AS user_id FROM customer)"


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a log: event type for ip, user for cookie."""
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("ip"),
        text("user_id").alias("cookie_id"),
    )


def line_prefs(spark: SparkSession, folder: str) -> DataFrame:
    """One preference per order line: customer, brand, quantity. Customers repeat brands."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    popular = heavy_in_table(lines, "l_partkey", ROWS_PER_SLICE)
    branded = sliced_join(lines, parts, "l_partkey", popular)
    return with_customer(spark, folder, branded, lines).select(
        text("o_custkey").alias("user_id"),
        F.col("p_brand").alias("item_id"),
        F.col("l_quantity").alias("pref"),
    )


def with_customer(
    spark: SparkSession, folder: str, rows: DataFrame, lines: DataFrame
) -> DataFrame:
    """Add ``o_custkey`` to rows made from the ``lines`` table by ``l_orderkey``."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    large = heavy_in_table(lines, "l_orderkey", ROWS_PER_SLICE)
    return sliced_join(rows, orders, "l_orderkey", large)


LINE_PREFS_SQL = """(
SELECT CAST(o_custkey AS VARCHAR) AS user_id, p_brand AS item_id, l_quantity AS pref
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def part_prefs(spark: SparkSession, folder: str) -> DataFrame:
    """One preference per order line: customer, part, quantity."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return with_customer(spark, folder, lines, lines).select(
        text("o_custkey").alias("user_id"), text("l_partkey").alias("item_id"), F.col("l_quantity").alias("pref")
    )


PART_PREFS_SQL = """(
SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id, l_quantity AS pref
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def brand_titles(spark: SparkSession, folder: str) -> DataFrame:
    """A title for the brands that have a part of size 1: ``(item_id, title)``."""
    return (
        table(spark, folder, "part")
        .where(F.col("p_size") == 1)
        .groupBy(F.col("p_brand").alias("item_id"))
        .agg(F.min("p_name").alias("title"))
    )


BRAND_TITLES_SQL = """(
SELECT p_brand AS item_id, min(p_name) AS title FROM part WHERE p_size = 1 GROUP BY p_brand)"""


def written_lines(df: DataFrame, line: Column, label: str) -> str:
    """Write ``line`` as text into the shared folder; returns the path."""
    path = new_folder(df.sparkSession, label)
    df.select(line.alias("value")).write.text(path)
    return path
