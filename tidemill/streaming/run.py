"""Starting streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemill.sinks.batches import BatchWriter

PARTITIONS = "spark.sql.shuffle.partitions"


def start(
    stream: DataFrame,
    checkpoint: str,
    writer: BatchWriter,
    mode: str = "append",
    every: str | None = None,
    partitions: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream into a batch writer.

    ``every`` is the trigger interval, such as ``"10 seconds"``; without it the stream takes what
    is there and stops. Starting again with the same checkpoint goes on where it left off.

    ``partitions`` is the number of parts the stream's state is kept in. It is fixed by the first
    start and each part costs a little in every batch, so a stream may want another number than
    the session's batch queries: by default one per core. Listeners know the query by its ``name``.
    """
    spark = stream.sparkSession
    session_partitions = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(partitions or spark.sparkContext.defaultParallelism))
    try:
        return _started(stream, checkpoint, writer, mode, every, name)
    finally:
        spark.conf.set(PARTITIONS, session_partitions)  # the running stream keeps its own copy


def _started(stream, checkpoint, writer, mode, every, name) -> StreamingQuery:
    out = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    out = out.queryName(name) if name else out
    out = out.trigger(processingTime=every) if every else out.trigger(availableNow=True)
    return out.foreachBatch(writer).start()


def run_to_end(stream: DataFrame, checkpoint: str, writer: BatchWriter, mode: str = "append") -> None:
    """Process everything available and wait for it."""
    start(stream, checkpoint, writer, mode).awaitTermination()


def to_console(stream: DataFrame, checkpoint: str, mode: str = "append", every: str = "10 seconds") -> StreamingQuery:
    """Show batches on the driver's console."""
    return (
        stream.writeStream.format("console")
        .outputMode(mode)
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )
