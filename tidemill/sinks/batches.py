"""Batch-wise output of streams that may be replayed.

Each micro-batch owns the folder ``batch_id=N`` and overwrites it, so a batch that runs again after
a failure leaves the same state as one that ran once. A query keeps its batch numbers in its
checkpoint: a new checkpoint over other input needs a new output folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.session import remove

BatchWriter = Callable[[DataFrame, int], None]

COMMITS = StructType([StructField("upto", LongType())])


def batch_writer(
    folder: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> BatchWriter:
    """``foreachBatch`` callback that writes each (transformed) batch to its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All batches written so far, with their ``batch_id``."""
    full = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(full).parquet(folder)


def increment_writer(folder: str, key: str, value: str) -> BatchWriter:
    """Callback that adds each batch's sums per key to the totals kept in ``folder``."""

    def sums(batch: DataFrame) -> DataFrame:
        return batch.groupBy(F.col(key).cast("string").alias("key")).agg(
            F.sum(F.col(value).cast("bigint")).alias("total")
        )

    return batch_writer(f"{folder}/batches", sums)


def _compacted_upto(spark: SparkSession, folder: str) -> int:
    try:
        commits = spark.read.schema(COMMITS).parquet(f"{folder}/commits")
        return commits.agg(F.max("upto")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return -1  # nothing has been compacted yet
        raise


def _increments(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    upto = _compacted_upto(spark, folder)
    rows = read_batches(spark, f"{folder}/batches", schema).where(F.col("batch_id") > upto)
    if upto >= 0:
        base = spark.read.schema(schema).parquet(f"{folder}/compacted/upto={upto}")
        rows = rows.unionByName(base.withColumn("batch_id", F.lit(upto).cast("bigint")))
    return rows


def read_totals(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """``(key, total)`` over everything added so far."""
    return _increments(spark, folder, schema).groupBy("key").agg(F.sum("total").alias("total"))


def compact_totals(spark: SparkSession, folder: str, schema: StructType) -> int:
    """Fold the batches so far into one table; returns the last batch in it.

    Run it between runs of the stream. The table counts from when its number is committed, after
    it is complete, so a failure half-way changes nothing. Batches and tables that the compaction before this
    one has made needless are deleted; what this one folds stays for who may be reading it.
    """
    done = _compacted_upto(spark, folder)
    rows = _increments(spark, folder, schema)
    upto = rows.agg(F.max("batch_id")).first()[0]
    if upto is None or upto <= done:
        return done
    totals = rows.where(F.col("batch_id") <= upto).groupBy("key").agg(F.sum("total").alias("total"))
    totals.write.mode("overwrite").parquet(f"{folder}/compacted/upto={upto}")
    spark.createDataFrame([(upto,)], COMMITS).coalesce(1).write.mode("append").parquet(
        f"{folder}/commits"
    )
    old = read_batches(spark, f"{folder}/batches", schema).where(F.col("batch_id") <= done)
    for row in old.select("batch_id").distinct().collect():
        remove(spark, f"{folder}/batches/batch_id={row['batch_id']}")
    earlier = spark.read.schema(COMMITS).parquet(f"{folder}/commits").where(F.col("upto") < done)
    for row in earlier.distinct().collect():
        remove(spark, f"{folder}/compacted/upto={row['upto']}")
    return upto
