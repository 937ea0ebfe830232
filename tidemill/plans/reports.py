"""Batch reports over delimited text: people, purchases and second-hand houses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators import people as p
from tidemill.operators import purchases as b
from tidemill.sources.text import parse_house, read_delimited, read_lines


def people_report(people: DataFrame) -> dict[str, DataFrame]:
    """The people statistics, each as a DataFrame."""
    count = F.count("*").alias("people")
    return {
        "men_above_180": p.taller_than(people, "M", 180).agg(count),
        "women_above_170": p.taller_than(people, "F", 170).agg(count),
        "by_gender": p.count_by_gender(people),
        "men_above_210": p.taller_than(people, "M", 210).orderBy("id").limit(50),
        "tallest": p.tallest(people, 50),
        "average_man": p.average_height(people, "M"),
        "tallest_woman": p.greatest_height(people, "F"),
    }


def people_from_text(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return people_report(read_delimited(spark, path, schemas.PEOPLE))


def purchase_report(users: DataFrame, purchases: DataFrame) -> dict[str, DataFrame]:
    """The purchase statistics, each as a DataFrame."""
    in_2015 = b.mentioning(purchases, "2015")
    return {
        "orders_2015": b.known_purchase_count(in_2015, users),
        "buyers_2015": b.buyer_count(in_2015, users),
        "orders_2014": b.dated(purchases, "2014").agg(F.count("*").alias("orders")),
        "orders_of_user_1": b.purchases_of(purchases, users, "1"),
        "prices_of_user_10": b.price_stats(purchases, users, "10"),
    }


def purchases_from_text(
    spark: SparkSession, users_path: str, purchases_path: str
) -> dict[str, DataFrame]:
    """Read both files, name them as views for SQL of one's own, and report."""
    users = read_delimited(spark, users_path, schemas.USERS)
    purchases = read_delimited(spark, purchases_path, schemas.PURCHASES)
    users.createOrReplaceTempView("user")
    purchases.createOrReplaceTempView("orders")
    return purchase_report(users, purchases)


def houses_from_text(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    houses = parse_house(read_lines(spark, path))
    houses.createOrReplaceTempView("housesecond")
    return {"houses": houses}
