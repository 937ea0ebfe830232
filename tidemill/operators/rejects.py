"""Counting the rows that a parser leaves out, in the pass that leaves them out.

The counts ride along as observed metrics: no second reading of the input, in batch and in streams
alike. A batch job asks an :class:`~pyspark.sql.Observation` after its action; a stream's counts are in the
progress of every batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

REJECTS = "rejects"


def accepted(rows: DataFrame, valid: Column, observation: Observation | str = REJECTS) -> DataFrame:
    """The rows that are ``valid``, while all are counted under ``observation``.

    An expression that is NULL makes a row invalid. Streams take a name, batch jobs an observation of their own.
    """
    sound = F.coalesce(valid, F.lit(False))
    counts = F.count(F.lit(1)).alias("rows"), F.count_if(~sound).alias("rejected")
    return rows.observe(observation, *counts).where(sound)


def counted(observation: Observation) -> dict[str, int]:
    """``accepted`` and ``rejected`` rows of a batch job whose action is done."""
    found = observation.get
    return {"accepted": found["rows"] - found["rejected"], "rejected": found["rejected"]}


def counted_in_stream(query: StreamingQuery, name: str = REJECTS) -> dict[str, int]:
    """The same over the batches that a stream remembers (``spark.sql.streaming.numRecentProgressUpdates``)."""
    total = {"accepted": 0, "rejected": 0}
    for progress in query.recentProgress:
        found = progress.observedMetrics.get(name)
        if found is not None:
            total["accepted"] += found["rows"] - found["rejected"]
            total["rejected"] += found["rejected"]
    return total
