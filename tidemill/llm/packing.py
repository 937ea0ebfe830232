"""Best-fit packing of documents into fixed-length sequences by a configuration linear program."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import bpe, kernels
from tidemill.session import stage

CAPACITY, END_ID = 1024, 2
STEPS, ETA = 1_200, 0.6
LARGE = 0.5  # extra worth of a length as long as a sequence: large items are harder to place late


def best_configuration(value: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Pricing: the multiset of lengths that fits one sequence and is worth most, as counts by length.

    Knapsack by dynamic programming over the filled length, repeats allowed; ``value[l]`` is the worth of
    length ``l``, and a length is used no more often than ``left`` says.
    """
    counts = np.zeros(len(value), np.int64)
    room = len(value) - 1
    while room > 0:
        more = _knapsack(value[: room + 1], (left - counts)[: room + 1])
        if not more.any():
            break
        counts[: room + 1] += more
        room -= int(more @ np.arange(room + 1))
    return counts


def _knapsack(value: np.ndarray, left: np.ndarray) -> np.ndarray:
    """One pass of the program; of equally good lengths the largest is used."""
    capacity = len(value) - 1
    worth = np.where(left > 0, value, -np.inf)
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    backward = worth[::-1]
    for full in range(1, capacity + 1):
        tried = backward[capacity - full : capacity] + best[:full]  # lengths full, full - 1, ..., 1
        at = int(tried.argmax())
        if tried[at] > best[full - 1]:
            best[full], choice[full] = tried[at], full - at
        else:
            best[full] = best[full - 1]
    counts, full = np.zeros(capacity + 1, np.int64), capacity
    while full > 0:
        length = int(choice[full])
        if not length:
            full -= 1
        elif counts[length] < left[length]:
            counts[length] += 1
            full -= length
        else:
            break  # the rest of the room is priced again without this length
    return counts


def fractional(histogram: np.ndarray, steps: int = STEPS, eta: float = ETA) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used, covering the histogram of lengths.

    Multiplicative weights: the worth of a length is its size times a factor that falls exponentially
    with the share of its items already covered, so that the lengths left over keep the shape of
    the whole histogram. Every step prices one configuration and uses it for a fixed part of the sequences
    that the total length asks for, or as often as its scarcest length allows.
    """
    capacity = len(histogram) - 1
    sizes = np.arange(capacity + 1)
    need = histogram.astype(float)
    left = need.copy()
    step = max(1.0, float(need @ sizes) / capacity / steps)
    found = []
    while left.max() > 1e-9 and len(found) < 2 * steps:
        covered = 1 - left / np.maximum(need, 1)
        value = sizes * (1 + LARGE * sizes / capacity) * np.exp(-eta * (covered - covered[need > 0].mean()))
        counts = best_configuration(value, np.ceil(left - 1e-9))
        used = counts > 0
        times = min(step, float((left[used] / counts[used]).min()))
        if times < 1:  # the scarcest length cannot fill whole sequences any more
            times = float(min(1.0, left[used].max()))
        found.append((counts, times))
        left = np.maximum(0, left - counts * times)
    return found


def rounded(histogram: np.ndarray, steps: int = STEPS) -> list[tuple[np.ndarray, int]]:
    """Whole configurations that hold every item exactly once.

    The uses of the linear program are rounded down, never beyond the items there are; what is left is
    packed largest first, each sequence filled by the knapsack's best fit and used as often as its items allow.
    """
    left = histogram.astype(np.int64).copy()
    whole = []
    for counts, times in fractional(histogram, steps):
        used = counts > 0
        number = min(int(times + 1e-9), int((left[used] // counts[used]).min()))
        if number > 0:
            whole.append((counts, number))
            left = left - counts * number
    sizes = np.arange(len(left))
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[largest] -= 1
        room = len(left) - 1 - largest
        counts = np.zeros_like(left)
        if room and rest[: room + 1].any():
            worth = sizes[: room + 1] * (1 + LARGE * sizes[: room + 1] / len(left))
            counts[: room + 1] = best_configuration(worth, rest[: room + 1])
        counts[largest] += 1
        used = counts > 0
        number = int((left[used] // counts[used]).min())
        whole.append((counts, number))
        left = left - counts * number
    return whole


def slots(plan: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, end rank, first sequence, items each, offset)`` for runs of equal places."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for counts, number in plan:
        offset = 0
        for length in np.flatnonzero(counts)[::-1].tolist():
            each = int(counts[length])
            start = ranks.get(length, 0)
            ranks[length] = start + each * number
            rows.append((length, start, ranks[length], sequence, each, offset))
            offset += each * length
        sequence += number
    return rows


def _tokenized(capacity: int, end_id: int, vocabulary: str, with_ids: bool):
    """Pieces of every text, with the number of the piece among those of its length in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in kernels.blocks(batches):
            ids, bounds = bpe.encode(batch.column("text"), vocabulary)
            out = {c: [] for c in ("doc", "piece", "start", "length", "crc", "rank")}
            tokens = []
            for doc, (s, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                own = np.append(ids[s:e], np.uint32(end_id)).astype("<u4")
                first = (len(own) - 1) % capacity + 1
                cuts = [0, *range(first, len(own) + 1, capacity)]
                for piece, (begin, stop) in enumerate(zip(cuts, cuts[1:])):
                    raw = own[begin:stop].tobytes()
                    length = stop - begin
                    for c, v in zip(out, (doc, piece, begin, length, zlib.crc32(raw), seen[length])):
                        out[c].append(v)
                    seen[length] += 1
                    if with_ids:
                        tokens.append(own[begin:stop])
            columns = [
                batch.column("doc_id").cast(pa.int64()).take(pa.array(out["doc"], pa.int64())),
                pa.array(out["piece"], pa.int32()),
                *(pa.array(out[c], pa.int64()) for c in ("start", "length", "crc", "rank")),
                pa.array(np.full(len(out["doc"]), part, np.int64)),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "rank", "part"]
            if with_ids:
                sizes = np.array([len(x) for x in tokens], np.int64)
                flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint32)
                columns.append(kernels.list_column(flat.astype(np.int32), sizes, pa.int32()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str = bpe.VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """Pack tokenized texts into as few sequences of ``capacity`` tokens as the method finds.

    Every text ends with ``end_id``; one longer than a sequence is cut into full pieces after a first piece
    of what remains. Full pieces fill a sequence each. For the others the driver reads the histogram of
    lengths (``capacity`` rows), solves the configuration program and sends back at most a few
    thousand runs of places, a number set by the steps of the method and not by the data. An item's run and
    place follow from its rank among the items of its length: its number in its task plus the numbers
    of the tasks before.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, on request, the ``ids``.
    A null text is an empty one: its only token is ``end_id``. Repeated rows are packed each; a null id stays null; an
    empty table gives an empty result.
    """
    kernels.small_batches(docs.sparkSession)
    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, rank bigint, part bigint"
    kinds += ", ids array<int>" if with_ids else ""
    pieces = stage(
        docs.select("doc_id", "text").mapInArrow(_tokenized(capacity, end_id, vocabulary, with_ids), kinds), "pieces"
    )
    short = pieces.where(F.col("length") < capacity)
    by_part = short.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    plan = rounded(histogram) if histogram.any() else []
    spark = docs.sparkSession
    runs = spark.createDataFrame(
        slots(plan), "length bigint, low bigint, high bigint, first_sequence bigint, each bigint, at bigint"
    )
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = by_part.select("length", "part", before.alias("before"))
    ranked = short.join(offsets, ["length", "part"]).withColumn("r", F.col("rank") + F.col("before"))
    inside = (F.col("r") >= F.col("low")) & (F.col("r") < F.col("high"))
    placed = ranked.join(F.broadcast(runs), "length").where(inside)
    turn = F.col("r") - F.col("low")
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]
    extra = ["ids"] if with_ids else []
    placed = placed.select(
        *out,
        (F.col("first_sequence") + F.floor(turn / F.col("each")).cast("bigint")).alias("sequence_id"),
        (F.col("at") + turn % F.col("each") * F.col("length")).alias("offset"),
        *extra,
    )
    full = pieces.where(F.col("length") == capacity)
    own = -1 - (F.shiftleft("part", 36) + F.col("rank"))  # below zero: no number of the plan
    return placed.union(full.select(*out, own.alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), *extra))
