"""Totals per key, and statistics per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def running_totals(clicks: DataFrame) -> DataFrame:
    """Clicks per user since the start, kept in the stream's state, for update output."""
    return clicks.where("valid").groupBy("uid").agg(F.sum("click_count").alias("total"))


def batch_report(sql: str, view: str) -> Callable[[DataFrame], DataFrame]:
    """Batch step that registers the batch as a view and reports by SQL."""

    def report(batch: DataFrame) -> DataFrame:
        batch.createOrReplaceTempView(view)
        return batch.sparkSession.sql(sql)

    return report
