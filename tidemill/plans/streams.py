"""Streaming jobs: traffic per minute, hottest searches, clicks per user.

Each takes a stream (see :mod:`tidemill.sources.streams`), an output folder and a checkpoint
folder, and returns the started query. ``every`` is the trigger interval; None runs to the end of
what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions.fields import clock_text
from tidemill.operators.traffic import pv_ip_uv
from tidemill.sinks.batches import batch_writer, increment_writer
from tidemill.sinks.ledger import Ledger, file_place, kafka_place
from tidemill.sinks.text import cached
from tidemill.sources.streams import parse_clicks
from tidemill.sources.text import parse_search, parse_timed_log
from tidemill.streaming.run import start
from tidemill.streaming.windows import hottest, item_windows, traffic_windows


def _log_rows(messages: DataFrame) -> DataFrame:
    return parse_timed_log(messages.select(F.col("value").alias("line")))


def traffic_per_batch(
    messages: DataFrame, out: str, checkpoint: str, every: str | None = "60 seconds"
) -> StreamingQuery:
    """Views, ips and visitors of each micro-batch, whatever the log times in it."""

    def report(batch: DataFrame) -> DataFrame:
        return pv_ip_uv(batch).select(clock_text(F.current_timestamp()).alias("time"), "*")

    return start(_log_rows(messages), checkpoint, batch_writer(out, report), "append", every)


def traffic_per_window(
    messages: DataFrame, out: str, checkpoint: str, every: str | None = "60 seconds", **windows
) -> StreamingQuery:
    """Views, ips and visitors per event-time window, once the window is closed."""
    counts = traffic_windows(_log_rows(messages), **windows)
    return start(counts, checkpoint, batch_writer(out), "append", every)


def hottest_searches(
    messages: DataFrame, out: str, checkpoint: str, every: str | None = "5 seconds", n: int = 3, **windows
) -> StreamingQuery:
    """Most frequent items per sliding window of ``name item`` lines with a ``timestamp``."""
    lines = messages.select(F.col("timestamp").alias("ts"), F.col("value").alias("line"))
    counts = item_windows(parse_search(lines), **windows)
    return start(counts, checkpoint, batch_writer(out, hottest(n)), "append", every)


def clicks_per_user(
    messages: DataFrame, out: str, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Add each micro-batch's clicks per user to the totals in ``out``.

    Messages that are no valid clicks go to ``out/rejects`` as they came.
    """
    add = increment_writer(out, "uid", "click_count")
    reject = batch_writer(f"{out}/rejects")

    def write(batch: DataFrame, batch_id: int) -> None:
        with cached(batch) as rows:
            add(rows.where("valid"), batch_id)
            reject(rows.where("NOT valid").select("raw"), batch_id)

    return start(parse_clicks(messages), checkpoint, write, "append", every)


def clicks_with_ledger(
    messages: DataFrame, out: str, checkpoint: str, every: str | None = "5 seconds"
) -> StreamingQuery:
    """As :func:`clicks_per_user`, with a ledger that lets the stream start again without its checkpoint.

    ``messages`` are Kafka messages or lines of files. Totals come from :meth:`Ledger.totals`.
    """
    ledger = Ledger(messages.sparkSession, out, checkpoint)
    placed = kafka_place(messages) if "offset" in messages.columns else file_place(messages)
    clicks = parse_clicks(ledger.unread(placed), keep=["source", "position"])
    return start(clicks, checkpoint, ledger.writer("uid", "click_count"), "append", every)
