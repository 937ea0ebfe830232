"""Sorted text output and caching for repeated reads."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_sorted_text(df: DataFrame, path: str, keys: list[str], line: Column) -> None:
    """Write one text line per row in the order of ``keys``.

    Files are named in order, so reading them by name gives the whole in order; no task writes
    it all. The line itself ends the sort order, which lets rows with equal keys share the work.
    """
    rows = df.withColumn("_line", line).orderBy(*keys, "_line")
    rows.select(F.col("_line").alias("value")).write.mode("overwrite").text(path)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` in memory, spilling to disk, while several results are taken from it."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
