"""Rows that came after their window had closed, counted per micro-batch.

Spark drops such rows inside its state operators and says how many in the progress of the batch. A
listener takes that number from every progress report and stores it in a folder beside the output.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

LATE = StructType(
    [
        StructField("watermark", StringType()),
        StructField("input_rows", LongType()),
        StructField("late_rows", LongType()),
    ]
)


class LateRows(StreamingQueryListener):
    """Stores one row per batch of the query called ``name`` below ``folder``.

    What is counted are rows as the state operator gets them: input rows of one task that fall into the
    same group were added up before. Where groups are single rows (a key of its own for each), these are the input rows.
    A batch that runs again overwrites its row.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self._spark, self._folder, self._name = spark, folder, name
        self._stored: set[int] = set()
        self._lock = threading.Lock()  # reports come in a thread of their own

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self._name:
            self._store(event.progress)

    def _store(self, progress) -> None:
        batch = progress.batchId
        with self._lock:
            if batch in self._stored:
                return
            late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            row = ((progress.eventTime or {}).get("watermark"), progress.numInputRows, late)
            frame = self._spark.createDataFrame([row], LATE).coalesce(1)
            frame.write.mode("overwrite").parquet(f"{self._folder}/batch_id={batch}")
            self._stored.add(batch)

    def finish(self, query: StreamingQuery) -> None:
        """Store what reports of a stopped query the listener has not been handed yet."""
        for progress in query.recentProgress:
            self._store(progress)


@contextmanager
def late_rows(spark: SparkSession, folder: str, name: str) -> Iterator[LateRows]:
    """Listen to the query ``name`` while the block runs."""
    listener = LateRows(spark, folder, name)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """``watermark, input_rows, late_rows, batch_id`` of every batch so far."""
    full = StructType([*LATE.fields, StructField("batch_id", LongType())])
    return spark.read.schema(full).parquet(folder)
