"""Keys that own a large share of a table's rows, found without shuffling the table by key."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.session import stage

MERGED_ROWS = 65_536
LEAST_SHARE = 1e-5  # keys with a smaller share of the rows are never asked for
LEAST_BUCKETS = 4_096


def _summary(share: float):
    """Counters of a task's keys that may own more than ``share`` of its rows.

    More counters than four times the number of keys that can: the least are given up and what they
    may have had is taken from all. A counter then falls short by ``cut`` at most.
    """
    most = math.ceil(4 / share)

    def summed(held: pa.Table | None, waiting: list[pa.Array]) -> pa.Table:
        counted = pc.value_counts(pa.chunked_array(waiting).drop_null())
        own = pa.table({"key": counted.field("values"), "n": counted.field("counts")})
        both = own if held is None else pa.concat_tables([held, own])
        return both.group_by("key").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, cut = None, 0, 0
        waiting, more = [], 0
        for batch in batches:
            waiting.append(batch.column(0))
            rows, more = rows + len(batch), more + len(batch)
            # As many rows as there are counters: putting them in costs no more for each row the more counters there are.
            if more < max(MERGED_ROWS, len(held or ())):
                continue
            held, waiting, more = summed(held, waiting), [], 0
            if len(held) > 2 * most:
                n = held["n"].to_numpy()
                least = int(np.partition(n, len(n) - most - 1)[len(n) - most - 1])
                held = held.filter(pa.array(n > least))
                held = held.set_column(1, "n", pa.array(held["n"].to_numpy() - least))
                cut += least
        if waiting:
            held = summed(held, waiting)
        if held is None:
            return
        found = held.filter(pa.array(held["n"].to_numpy() + cut > share * rows))
        yield from found.select(["key", "n"]).combine_chunks().to_batches()

    return run


def frequent_keys(df: DataFrame, key: str, more_than: int, rows: int) -> DataFrame:
    """``(key, n)`` of the non-null keys with over ``more_than`` of the ``rows`` rows of a stored table, exactly counted.

    A key that owns a share of all rows owns as large a share of those of some task. So every task sums up its own rows
    (a bounded number of counters) and names the keys that may; only rows of these keys are counted, whose
    number hangs on the tasks and the share and not on the keys. ``more_than`` is taken for :data:`LEAST_SHARE` of the rows if it is less.
    """
    share = max(more_than / max(rows, 1), LEAST_SHARE)
    kind = StructType([StructField("key", df.schema[key].dataType), StructField("n", LongType())])
    named = df.select(key).mapInArrow(_summary(share), kind).select("key").distinct()
    named = stage(named, "frequent")
    few = named.count() <= 1_000_000
    candidates = named.withColumnRenamed("key", key)
    counted = df.select(key).join(F.broadcast(candidates) if few else candidates, key, "left_semi")
    counted = counted.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > max(more_than, math.floor(share * rows)))


def keys_above(df: DataFrame, key: str, more_than: int, rows: int) -> DataFrame | None:
    """What :func:`frequent_keys` finds, for a threshold that few keys or none reach; None when no key can.

    Rows are counted by hash buckets of the key, several for each key that can be above the threshold. A key is no larger than its bucket,
    so only rows of the buckets above it are counted by key; mostly there are none, and all is one pass that keeps some thousand counters.
    """
    least = max(more_than, math.floor(max(more_than / max(rows, 1), LEAST_SHARE) * rows))
    buckets = max(LEAST_BUCKETS, math.ceil(16 * rows / max(least, 1)))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    named = df.where(F.col(key).isNotNull())
    sizes = named.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("n"))
    large = stage(sizes.where(F.col("n") > least).select("_bucket"), "large-buckets")
    if large.isEmpty():
        return None
    counted = named.select(key).withColumn("_bucket", bucket).join(F.broadcast(large), "_bucket", "left_semi")
    return counted.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > least)
