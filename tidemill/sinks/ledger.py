"""Totals with a ledger of what they were made from.

A checkpoint knows how far a stream has read; the totals do not, so with the checkpoint all is lost. The
ledger says it with the results: every batch stores its sums and then the ranges of the source it
read. A batch counts from when its ranges are there. A stream that starts without its checkpoint
begins a new epoch, reads the source from the beginning and leaves out all that the ledger has.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemill.operators.skew import lookup
from tidemill.session import stage
from tidemill.sinks.batches import BatchWriter
from tidemill.sinks.text import cached

SUMS = StructType([StructField("key", StringType()), StructField("total", LongType())])
RANGES = StructType(
    [
        StructField("source", StringType()),
        StructField("first", LongType()),
        StructField("last", LongType()),
        StructField("rows", LongType()),
    ]
)
_BATCH = [StructField("epoch", LongType()), StructField("batch_id", LongType())]
_EPOCH = StructType([StructField("epoch", LongType())])


def file_place(stream: DataFrame) -> DataFrame:
    """Add ``source`` and ``position`` to the rows of a file stream: files are read whole, so all have position 0."""
    return stream.select("*", F.input_file_name().alias("source"), F.lit(0).cast("bigint").alias("position"))


def kafka_place(stream: DataFrame) -> DataFrame:
    """Add ``source`` and ``position`` to Kafka messages: topic with partition, and offset."""
    source = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    return stream.select("*", source.alias("source"), F.col("offset").alias("position"))


class Ledger:
    """Sums and ranges in ``folder``, for the stream that has its checkpoint in ``checkpoint``."""

    def __init__(self, spark: SparkSession, folder: str, checkpoint: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.epoch = self._epoch(f"{checkpoint.rstrip('/')}/epoch")

    def _read(self, path: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _epoch(self, marker: str) -> int:
        """The number that this checkpoint was given on its first start."""
        own = self._read(marker, _EPOCH).first()
        if own:
            return own["epoch"]
        starts = self._read(f"{self.folder}/epochs", _EPOCH)
        epoch = (starts.agg(F.max("epoch")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(epoch,)], _EPOCH).coalesce(1)
        row.write.mode("append").parquet(f"{self.folder}/epochs")  # before any batch of the epoch
        row.write.mode("overwrite").parquet(marker)
        return epoch

    def ranges(self) -> DataFrame:
        """``source, first, last, rows, epoch, batch_id`` of all that has been counted."""
        return self._read(f"{self.folder}/ledger", StructType([*RANGES.fields, *_BATCH]))

    def unread(self, placed: DataFrame) -> DataFrame:
        """Rows of a stream with ``source`` and ``position`` that no earlier epoch has counted.

        What the own epoch has read, its checkpoint knows.
        """
        earlier = self.ranges().where(F.col("epoch") < self.epoch)
        if earlier.isEmpty():
            return placed
        known = stage(earlier.groupBy("source").agg(F.max("last").alias("_last")), "ranges")
        rows = lookup(placed, known, "source") if not placed.isStreaming else placed.join(known, "source", "left")
        return rows.where(F.col("_last").isNull() | (F.col("position") > F.col("_last"))).drop("_last")

    def starting_offsets(self) -> str:
        """Kafka's ``startingOffsets`` behind all that has been counted."""
        rows = self.ranges().groupBy("source").agg(F.max("last").alias("last")).collect()  # a row per partition
        offsets: dict[str, dict[str, int]] = {}
        for row in rows:
            topic, partition = row["source"].rsplit("/", 1)
            offsets.setdefault(topic, {})[partition] = row["last"] + 1
        return json.dumps(offsets, sort_keys=True)

    def _committed(self, batch_id: int) -> bool:
        own = (F.col("epoch") == self.epoch) & (F.col("batch_id") == batch_id)
        return not self.ranges().where(own).isEmpty()

    def writer(self, key: str, value: str) -> BatchWriter:
        """``foreachBatch`` callback that stores each batch's sums, then its ranges.

        Rows without a key or a value are read but add nothing. A batch that is delivered again after its ranges were stored is left as it is; one that stopped before is written anew.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            if self._committed(batch_id):
                return
            at = f"epoch={self.epoch}/batch_id={batch_id}"
            with cached(batch) as rows:
                counted = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull())
                sums = counted.groupBy(F.col(key).cast("string").alias("key")).agg(F.sum(F.col(value).cast("bigint")).alias("total"))
                sums.write.mode("overwrite").parquet(f"{self.folder}/sums/{at}")
                read = rows.groupBy("source").agg(
                    F.min("position").alias("first"), F.max("position").alias("last"), F.count("*").alias("rows")
                )
                read.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ledger/{at}")  # one file: there or not

        return write

    def totals(self) -> DataFrame:
        """``(key, total)`` over the batches whose ranges are in the ledger."""
        done = self.ranges().select("epoch", "batch_id").distinct()
        sums = self._read(f"{self.folder}/sums", StructType([*SUMS.fields, *_BATCH]))
        return sums.join(done, ["epoch", "batch_id"], "left_semi").groupBy("key").agg(F.sum("total").alias("total"))
