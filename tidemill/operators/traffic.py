"""Counts of page views, addresses and visitors; sums and statistics per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pv_ip_uv(log: DataFrame) -> DataFrame:
    """Views, distinct ips and distinct cookies of a whole log, exactly."""
    return log.agg(
        F.count("*").alias("pv"),
        F.countDistinct("ip").alias("ips"),
        F.countDistinct("cookie_id").alias("uv"),
    )


def sum_by_key(df: DataFrame, key: str, value: str, total: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(total))


def column_stats(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, population deviation, greatest and least of a numeric column."""
    return df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_pop(column).alias("stdev"),
        F.max(column).alias("max"),
        F.min(column).alias("min"),
    )
