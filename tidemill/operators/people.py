"""Statistics of people by gender and height."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def taller_than(people: DataFrame, gender: str, height: float) -> DataFrame:
    """People of one gender above a height."""
    return people.where((F.col("height") > height) & (F.col("gender") == gender)).select(
        "id", "gender", "height"
    )


def count_by_gender(people: DataFrame) -> DataFrame:
    return people.groupBy("gender").count()


def tallest(people: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` greatest heights in descending order; equal heights go by id."""
    return people.orderBy(F.desc("height"), "id").limit(n)


def average_height(people: DataFrame, gender: str) -> DataFrame:
    return people.where(F.col("gender") == gender).agg(F.avg("height").alias("avg_height"))


def greatest_height(people: DataFrame, gender: str) -> DataFrame:
    return people.where(F.col("gender") == gender).agg(F.max("height").alias("max_height"))
