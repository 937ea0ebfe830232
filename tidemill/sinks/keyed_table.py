"""A table of totals per key that a stream adds to, in versions.

Keys are dealt to a fixed number of buckets by hash. A batch reads and rewrites only the buckets it
touches, into a folder of its own version, and then commits: one small file names, for every
bucket, the version that holds it. Readers take the last committed file, so they see all of a
batch or nothing of it, and a batch that stops before its commit leaves no trace in any reading.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemill.session import remove
from tidemill.sinks.batches import BatchWriter
from tidemill.sinks.text import cached

BUCKETS = 64
KEPT = 3  # versions that a reader may still be reading
NONE = -1

ROWS = StructType([StructField("key", StringType()), StructField("total", LongType())])
COMMIT = StructType(
    [
        StructField("version", LongType()),
        StructField("batch_id", LongType()),
        StructField("buckets", ArrayType(LongType())),
    ]
)


@dataclass(frozen=True)
class State:
    """A committed version: the last batch in it, and the version that holds each bucket."""

    version: int
    batch_id: int
    buckets: list[int]


class KeyedTable:
    """Totals ``(key, total)`` in ``folder``.

    The number of buckets is fixed by the first batch. It should let a bucket's keys fit a few tasks: a larger bucket is
    written by several. One stream writes at a time; any number of readers may read meanwhile.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, kept: int = KEPT):
        self.spark, self.folder, self.kept = spark, folder.rstrip("/"), kept
        self._first = State(0, NONE, [NONE] * buckets)

    def states(self) -> list[State]:
        """Committed versions that are still there, oldest first."""
        try:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.folder}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []  # no batch has been committed
        return sorted((State(r["version"], r["batch_id"], list(r["buckets"])) for r in rows), key=lambda s: s.version)

    def state(self) -> State:
        return (self.states() or [self._first])[-1]

    def _path(self, state: State, bucket: int) -> str:
        return f"{self.folder}/data/version={state.buckets[bucket]}/bucket={bucket}"

    def _rows(self, state: State, buckets: list[int]) -> DataFrame:
        paths = [self._path(state, b) for b in buckets if state.buckets[b] != NONE]
        if not paths:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*paths)

    def read(self, state: State | None = None) -> DataFrame:
        """The totals as of the last commit, or of a given one."""
        state = state or self.state()
        return self._rows(state, list(range(len(state.buckets))))

    def lookup(self, key: str) -> DataFrame:
        """The total of one key, from its bucket alone."""
        state = self.state()
        bucket = self.spark.range(1).select(self._bucket(F.lit(key), len(state.buckets))).first()[0]
        return self._rows(state, [bucket]).where(F.col("key") == key)

    @staticmethod
    def _bucket(key, buckets: int):
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def add(self, increments: DataFrame, batch_id: int) -> None:
        """Add ``(key, total)`` rows of a batch once, however often the batch is delivered.

        Batches come in ascending order; one that is not beyond the last committed is a replay.
        """
        state = self.state()
        if batch_id <= state.batch_id:
            return
        sums = increments.groupBy(F.col("key").cast("string").alias("key")).agg(F.sum("total").alias("total"))
        with cached(sums.withColumn("bucket", self._bucket(F.col("key"), len(state.buckets)))) as own:
            touched = sorted(row["bucket"] for row in own.select("bucket").distinct().collect())
            self._commit(state, self._write(state, own, touched), touched, batch_id)
        self._tidy()

    def _write(self, state: State, own: DataFrame, touched: list[int]) -> int:
        version = state.version + 1
        if touched:
            both = self._rows(state, touched).unionByName(own.select("key", "total"))
            totals = both.groupBy("key").agg(F.sum("total").alias("total"))
            totals = totals.withColumn("bucket", self._bucket(F.col("key"), len(state.buckets))).hint("rebalance", "bucket")
            totals.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/data/version={version}")
        return version

    def _commit(self, state: State, version: int, touched: list[int], batch_id: int) -> None:
        buckets = [version if b in set(touched) else held for b, held in enumerate(state.buckets)]
        row = self.spark.createDataFrame([(version, batch_id, buckets)], COMMIT)
        # one file, which its writer renames into place: there or not there
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/commits/at={version}")

    def _tidy(self) -> None:
        """Remove versions that are neither current nor likely to be read, commits before their data."""
        states = self.states()
        for old, following in zip(states, states[1 : len(states) - self.kept + 1]):
            remove(self.spark, f"{self.folder}/commits/at={old.version}")
            for bucket, (held, then) in enumerate(zip(old.buckets, following.buckets)):
                if held not in (NONE, then):
                    remove(self.spark, self._path(old, bucket))

    def writer(self, key: str, value: str) -> BatchWriter:
        """``foreachBatch`` callback that adds each batch's sums."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.add(batch.select(F.col(key).alias("key"), F.col(value).cast("bigint").alias("total")), batch_id)

        return write
