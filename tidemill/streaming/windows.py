"""Counts per event-time window.

Streams need a ``ts`` column of type timestamp. Counts come from Spark's own state, keyed by window
and key, so no task holds a window's keys at once. Append output has a window once, when the
watermark has passed its end; update output has it each time it changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Window lengths, slide and top size of the original reports: fixed values.
TRAFFIC_WINDOW = "60 seconds"
HOT_WINDOW = "60 seconds"
HOT_SLIDE = "20 seconds"
HOT_TOP = 3


def _flat(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns
    )


def traffic_windows(
    log: DataFrame, window: str = TRAFFIC_WINDOW, delay: str = "1 minute"
) -> DataFrame:
    """Exact views, ips and visitors (cookies) per tumbling window, for append output.

    Streams have no distinct count, so each row is counted twice, under its ip and under its
    cookie; the number of counters per window is then the distinct count. NULL keys are views
    but no visitors.
    """
    both = F.array(
        F.struct(F.lit("ip").alias("kind"), F.col("ip").alias("value")),
        F.struct(F.lit("cookie").alias("kind"), F.col("cookie_id").alias("value")),
    )
    counters = (
        log.withWatermark("ts", delay)
        .select("ts", F.inline(both))
        .groupBy(F.window("ts", window), "kind", "value")
        .agg(F.count("*").alias("views"))
    )
    is_ip = F.col("kind") == "ip"
    totals = counters.groupBy("window").agg(
        F.sum(F.when(is_ip, F.col("views"))).alias("pv"),
        F.count(F.when(is_ip, F.col("value"))).alias("ips"),
        F.count(F.when(~is_ip, F.col("value"))).alias("uv"),
    )
    return _flat(totals, "pv", "ips", "uv")


# Buckets of a visitor sketch, as a power of two: 16,384 give a standard error of 0.7 %.
SKETCH_BITS = 14


def visitor_sketches(
    log: DataFrame, window: str = TRAFFIC_WINDOW, delay: str = "1 minute", bits: int = SKETCH_BITS
) -> DataFrame:
    """Views and a HyperLogLog sketch of the visitors (cookies) per tumbling window, for append output.

    A window's state is one sketch however many visitors it has, where :func:`traffic_windows` keeps a
    counter for each. Stored sketches unite to longer periods without the rows (:func:`united`).
    NULL cookies are views but no visitors.
    """
    sketches = (
        log.withWatermark("ts", delay)
        .groupBy(F.window("ts", window))
        .agg(F.count("*").alias("pv"), F.hll_sketch_agg("cookie_id", F.lit(bits)).alias("visitors"))
    )
    return _flat(sketches, "pv", "visitors")


def united(sketches: DataFrame, period: Column) -> DataFrame:
    """Views and estimated visitors per ``period``, an expression over the windows' times.

    Sketches may be united in any order and any number of steps with the same result.
    """
    whole = F.hll_sketch_estimate(F.hll_union_agg("visitors"))
    return sketches.groupBy(period.alias("period")).agg(F.sum("pv").alias("pv"), whole.alias("uv"))


def item_windows(
    searches: DataFrame,
    item: str = "item",
    window: str = HOT_WINDOW,
    slide: str = HOT_SLIDE,
    delay: str = "1 minute",
) -> DataFrame:
    """Count of each item per sliding window."""
    counts = (
        searches.where(F.col(item).isNotNull())
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", window, slide), F.col(item).alias("item"))
        .agg(F.count("*").alias("n"))
    )
    return _flat(counts, "item", "n")


def hottest(n: int = HOT_TOP) -> Callable[[DataFrame], DataFrame]:
    """Batch step that keeps each window's ``n`` most frequent items, equal counts by item.

    A stream cannot rank, so this runs per micro-batch of append output, where a window comes
    whole and once.
    """

    def keep(counts: DataFrame) -> DataFrame:
        order = Window.partitionBy("window_start", "window_end").orderBy(F.desc("n"), "item")
        return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    return keep


def latest(batches: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Last value per key of update output read back from its batches."""
    return batches.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))
