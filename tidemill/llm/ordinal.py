"""Quality grades of documents by ordinal cumulative-link regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import kernels

BUCKET_BITS = 18
GRADES = 3
STEM_BYTES = 6
LEAST_TAIL = 0.45  # probability of the best grade that a selected document needs
SAMPLE_ROWS = 6_000  # labelled documents that the model is fitted on, at most
STEPS, RATE, PENALTY = 150, 0.05, 2e-5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SYMBOLS = np.where(_LETTER, 0, np.random.default_rng(9_009).integers(1, 2**63, 256)).astype(np.uint64)


@dataclass(frozen=True)
class OrdinalModel:
    """Weights shared by all grades, and rising thresholds between neighbouring grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade >= 1), P(grade >= 2), ...`` of each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of a block of texts: text numbers, ascending, and buckets.

    Features are the words (A-Z in lower case), their first :data:`STEM_BYTES` bytes standing once, twice and
    four times, what symbols a word carries, and steps of the shares of repeated neighbours, of distinct words and of
    symbols.
    """
    words = kernels.Words(column, lower=True)
    own, count = words.hashes(), words.counts()
    texts = np.arange(len(count))
    doc = np.repeat(texts, count)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SYMBOLS[words.data])))
    marks = sums[words.end] - sums[words.start]
    marked = marks != 0
    again = np.zeros(len(own), bool)
    again[1:] = (own[1:] == own[:-1]) & (doc[1:] == doc[:-1])
    low = np.uint64(2**BUCKET_BITS - 1)

    def bucket(values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)

    pairs = np.unique(doc << BUCKET_BITS | bucket(own))
    letters = kernels.prefix(kernels.BYTE_VALUES[words.data], kernels.BYTE_BASE)
    long = words.end - words.start >= STEM_BYTES
    at = words.start[long]
    stem = kernels.mix(kernels.span_hash(letters, at, at + STEM_BYTES, kernels.BYTE_BASE), 29)
    stems, often = np.unique(doc[long] << 40 | (stem >> np.uint64(24)).astype(np.int64), return_counts=True)
    known = (stems & (2**40 - 1)).astype(np.uint64)
    repeated = [
        (stems[often >= least] >> 40) << BUCKET_BITS | bucket(kernels.mix(known[often >= least], 40 + least))
        for least in (1, 2, 4)
    ]
    distinct = np.bincount(pairs >> BUCKET_BITS, minlength=len(texts))
    total = np.maximum(count, 1)
    symbol_count = np.concatenate(([0], np.cumsum(~_LETTER[words.data])))
    size = np.diff(words.bounds)
    symbols = (symbol_count[words.bounds[1:]] - symbol_count[words.bounds[:-1]] - count).clip(0) / np.maximum(size, 1)
    steps = [
        np.ceil(20 * np.bincount(doc, again, minlength=len(texts)) / total),
        np.ceil(20 * distinct / total),
        np.ceil(40 * symbols),
        np.floor(np.log2(total)),
    ]
    extra = [
        (texts << BUCKET_BITS) | bucket(kernels.mix(step.astype(np.uint64), 31 + i))
        for i, step in enumerate(steps)
    ]
    shapes = doc[marked] << BUCKET_BITS | bucket(kernels.mix(marks[marked], 30))
    pairs = np.unique(np.concatenate((pairs, shapes, *repeated, *extra)))
    return pairs >> BUCKET_BITS, pairs & int(low)


def _scale(doc: np.ndarray, texts: int) -> np.ndarray:
    return 1 / np.sqrt(np.maximum(1, np.bincount(doc, minlength=texts)))


def fit(doc: np.ndarray, bucket: np.ndarray, grades: np.ndarray, size: int = GRADES) -> OrdinalModel:
    """Cumulative logit model by full-batch Adam; the same data give the same model.

    Every grade has the same say in the loss, whatever its share of the sample.
    """
    texts = len(grades)
    scale = _scale(doc, texts)
    value = scale[doc]
    share = np.bincount(grades, minlength=size)
    weight = (1 / np.maximum(share, 1))[grades]
    weight /= weight.sum()
    w = np.zeros(2**BUCKET_BITS)
    cuts = np.zeros(size - 1)  # first threshold, then logarithms of the gaps
    first, second = np.zeros(len(w) + len(cuts)), np.zeros(len(w) + len(cuts))
    for step in range(1, STEPS + 1):
        gaps = np.concatenate((cuts[:1], np.exp(cuts[1:])))
        thresholds = np.cumsum(gaps)
        scores = np.bincount(doc, w[bucket] * value, minlength=texts)
        tails = OrdinalModel(w, thresholds).tails(scores)
        full = np.concatenate((np.ones((texts, 1)), tails, np.zeros((texts, 1))), axis=1)
        slope = full * (1 - full)
        rows = np.arange(texts)
        own = np.maximum(full[rows, grades] - full[rows, grades + 1], 1e-9)
        up, down = slope[rows, grades] / own, slope[rows, grades + 1] / own
        # minus log likelihood: d/dscore, and d/dthreshold below and above the own grade
        by_score = weight * (down - up)
        by_cut = np.zeros((texts, size + 1))
        by_cut[rows, grades] += up * weight
        by_cut[rows, grades + 1] -= down * weight
        by_threshold = by_cut[:, 1:-1].sum(axis=0)
        by_gap = np.cumsum(by_threshold[::-1])[::-1] * np.concatenate((np.ones(1), np.exp(cuts[1:])))
        by_weight = np.bincount(bucket, (by_score * scale)[doc], minlength=len(w)) + PENALTY * w
        slope_all = np.concatenate((by_weight, by_gap))
        first = 0.9 * first + 0.1 * slope_all
        second = 0.999 * second + 0.001 * slope_all**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w = w - move[: len(w)] * 10
        cuts = cuts - move[len(w) :]
    thresholds = np.cumsum(np.concatenate((cuts[:1], np.exp(cuts[1:]))))
    return OrdinalModel(w.astype(np.float32), thresholds)


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in kernels.blocks(batches):
        doc, bucket = features(batch.column("text"))
        lists = kernels.list_column(bucket, np.bincount(doc, minlength=batch.num_rows), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("grade").cast(pa.int32()), lists], ["grade", "buckets"])


def graded(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)``: 0 toxic, 1 low quality, 2 good. Rows without a rating are left out.

    Of several ratings of one document the lowest grade counts.
    """
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") <= 0, 1).when(F.col("quality") > 0, 2)
    rows = labels.select("doc_id", grade.alias("grade")).where("doc_id is not null and grade is not null")
    return rows.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on the ``sample_rows`` rated documents that come first in a fixed hash order.

    The bound holds the ids that are broadcast and the features that the driver reads. Without any
    rated document all weights are zero and every document gets the same grade.
    """
    kernels.small_batches(docs.sparkSession)
    chosen = ratings.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "grade")
    table = rows.mapInArrow(_features_of, "grade int, buckets array<int>").toArrow()
    if not table.num_rows:
        return OrdinalModel(np.zeros(2**BUCKET_BITS, np.float32), np.arange(1.0, GRADES))
    lists = table.column("buckets").combine_chunks()
    bucket = lists.flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(table.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return fit(doc, bucket, table.column("grade").to_numpy())


def score_texts(column: pa.Array, model: OrdinalModel) -> np.ndarray:
    doc, bucket = features(column)
    return np.bincount(doc, model.weights[bucket], minlength=len(column)) * _scale(doc, len(column))


def grade_documents(docs: DataFrame, model: OrdinalModel, least_tail: float = LEAST_TAIL) -> DataFrame:
    """``docs`` with ``expected_grade``, the tails ``p_1`` (grade 1 or better), ``p_2``, and ``selected``.

    A document is selected if the probability of the best grade is at least ``least_tail``. Null and
    empty texts are graded by having no words. Own columns of these names are replaced.
    """
    names = ["expected_grade", *[f"p_{i}" for i in range(1, GRADES)], "selected"]
    kernels.small_batches(docs.sparkSession)
    rows = docs.drop(*names)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            tails = sent.value.tails(score_texts(batch.column("text"), sent.value))
            new = [pa.array(tails.sum(axis=1)), *(pa.array(t) for t in tails.T), pa.array(tails[:, -1] >= least_tail)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    schema = T.StructType(list(rows.schema))
    for name in names:
        schema = schema.add(name, "boolean" if name == "selected" else "double")
    return rows.mapInArrow(run, schema)
