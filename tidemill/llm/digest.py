"""Document fingerprints: improbable features in chained Bloom filters."""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import kernels

WINDOW = 64  # bytes of a feature, and features of a popularity window
POPULAR = 16  # popularity windows that a feature must win
SHORT, SMALL = 512, 8  # a text of so many bytes at most has all its windows of so few bytes as features
FILTER_BITS, HASHES, FILTER_FEATURES = 2048, 5, 160
LEVELS = 1000  # steps of entropy between 0 and the most that a window can have
WEAK = 100  # steps of entropy at and below which a window is no feature
RANGE_ROWS, MAX_RANGES = 4_000, 100_000
READY_CHARS = 1 << 18  # of texts whose fingerprints are made together
_STRETCH = 1 << 15  # windows whose entropies are made together
_PLACE_BITS = 22  # of a number that has a place below a rank, where that many are enough

_COUNTS = np.arange(WINDOW + 2, dtype=float)
_TERMS = np.zeros(WINDOW + 2)
_TERMS[1:] = _COUNTS[1:] * np.log2(_COUNTS[1:])
_TERMS = np.round(_TERMS * 2**20).astype(np.int64)
_GAIN = np.diff(_TERMS)  # of one more equal byte


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy step of every window of :data:`WINDOW` bytes.

    A byte that comes into a window, or leaves it, changes the window's sum by the gain of its count among the other bytes
    there. These counts are sums of comparisons of the bytes with themselves, shifted. Sums are whole numbers, so equal
    windows have equal entropy wherever they stand.
    """
    count = max(0, len(data) - WINDOW + 1)
    found = np.empty(count, np.int16)
    for at in range(0, count, _STRETCH):
        part = np.ascontiguousarray(data[at : at + _STRETCH + WINDOW - 1])
        before, after = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        equal = np.empty(len(part), bool)
        for shift in range(1, WINDOW):
            same = np.equal(part[shift:], part[:-shift], out=equal[shift:]).view(np.uint8)
            before[shift:] += same
            after[:-shift] += same
        sums = np.cumsum(_GAIN[before])[WINDOW - 1 :]
        sums[1:] -= np.cumsum(_GAIN[after[: len(sums) - 1]])
        bits = math.log2(WINDOW) - sums / (2**20 * WINDOW)
        found[at : at + len(sums)] = np.clip(np.round(bits * LEVELS / math.log2(WINDOW)), 0, LEVELS)
    return found


def _ends(bounds: np.ndarray, count: int) -> np.ndarray:
    """Where the text ends that each of the first ``count`` bytes stands in."""
    return np.repeat(bounds[1:], np.diff(bounds))[:count]


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LEVELS + 1, np.int64)
    for batch in kernels.blocks(batches, most=4 * READY_CHARS):
        data, bounds = kernels.text_buffer(batch.column("text"))
        level = entropies(data)
        inside = np.arange(WINDOW, len(level) + WINDOW) <= _ends(bounds, len(level))
        total += np.bincount(level[inside], minlength=LEVELS + 1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS + 1)), pa.array(total)], ["level", "n"])


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of every entropy step, the rarest over all windows of the corpus first; weak steps come last."""
    counts = docs.select("text").mapInArrow(_histogram, "level bigint, n bigint")
    found = np.zeros(LEVELS + 1, np.int64)
    for row in counts.groupBy("level").agg(F.sum("n").alias("n")).collect():  # LEVELS + 1 rows
        found[row["level"]] = row["n"]
    order = np.lexsort((np.arange(LEVELS + 1), found))
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[order] = np.arange(LEVELS + 1)
    ranks[: WEAK + 1] = LEVELS + 1
    return ranks


def fingerprints(column: pa.Array, ranks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its Bloom filters ``[filters, bytes]`` and the number of features in each.

    A feature is a window that is the leftmost rarest of at least :data:`POPULAR` runs of :data:`WINDOW` windows. Of a short text,
    and of one without such a window, every window of :data:`SMALL` bytes is a feature; one of fewer bytes gives a
    single feature, all of it; an empty text has no filter.
    """
    data, bounds = kernels.text_buffer(column)
    sums = kernels.prefix(kernels.BYTE_VALUES[data], kernels.BYTE_BASE)
    rows = _rare(data, bounds, ranks)
    names = kernels.mix(kernels.span_hash(sums, rows, rows + WINDOW, kernels.BYTE_BASE), 50)
    size, rare = np.diff(bounds), np.diff(np.searchsorted(rows, bounds))
    small = (size >= SMALL) & ((size <= SHORT) | (rare == 0))
    tiny = np.flatnonzero((size > 0) & ~small & (rare == 0))
    # features of all texts: rare windows, all windows of small texts, and whole texts, in their order
    text = np.repeat(np.arange(len(size)), rare)
    large = ~small[text]
    windows = np.where(small, size - SMALL + 1, 0)
    at = np.arange(windows.sum()) + np.repeat(bounds[:-1] - (np.cumsum(windows) - windows), windows)
    raw = [hashlib.sha256(data[bounds[i] : bounds[i + 1]].tobytes()).digest()[:8] for i in tiny.tolist()]
    text = np.concatenate((text[large], np.repeat(np.arange(len(size)), windows), tiny))
    names = np.concatenate(
        (names[large], kernels.mix(kernels.span_hash(sums, at, at + SMALL, kernels.BYTE_BASE), 51), np.frombuffer(b"".join(raw), np.uint64))
    )
    order = np.lexsort((names, text))  # equal features of a text stay in their order: the first one counts
    text, names = text[order], names[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (names[1:] != names[:-1])
    text, names, order = text[new], names[new], order[new]
    order = np.lexsort((order, text))
    text, names = text[order], names[order]
    count = np.bincount(text, minlength=len(size))
    filters = -(-count // FILTER_FEATURES)
    first = np.concatenate(([0], np.cumsum(filters)))
    place = first[text] + (np.arange(len(text)) - (np.cumsum(count) - count)[text]) // FILTER_FEATURES
    bits = np.zeros((first[-1], FILTER_BITS), bool)
    for turn in range(HASHES):
        bits[place, (names >> np.uint64(11 * turn)).astype(np.int64) % FILTER_BITS] = True
    packed, held = np.packbits(bits, axis=1), np.bincount(place, minlength=first[-1])
    return [(packed[s:e], held[s:e]) for s, e in zip(first[:-1].tolist(), first[1:].tolist())]


def _rare(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of the windows that are the leftmost rarest of enough runs of windows of their text."""
    level = entropies(data)
    if not len(level):
        return np.zeros(0, np.int64)
    end = _ends(bounds, len(level))
    places = np.arange(len(level))
    inside = places + WINDOW <= end
    kind, shift = (np.uint32, _PLACE_BITS) if len(level) < 2**_PLACE_BITS else (np.int64, 40)
    own = np.where(inside, ranks.astype(kind)[level], kind(LEVELS + 2)) << kind(shift) | places.astype(kind)
    # runs are cut at the end of a text: windows there get places that never win
    least = kernels.sliding_min(np.concatenate((own, np.full(WINDOW - 1, 1023 << shift, kind))), WINDOW)[: len(own)]
    winner = (least & kind(2**shift - 1)).astype(np.int64)
    real = inside & (least < kind((LEVELS + 1) << shift)) & (winner < end)
    return np.flatnonzero(np.bincount(winner[real], minlength=len(own)) >= POPULAR)


def _ones(filters: np.ndarray) -> np.ndarray:
    """Number of bits that are set in each filter."""
    return np.bitwise_count(filters.view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _score(common: np.ndarray, ones_a: np.ndarray, ones_b: np.ndarray) -> np.ndarray:
    most = np.minimum(ones_a, ones_b)
    chance = ones_a * ones_b / FILTER_BITS
    return np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1)


def _one_way(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    ones = _ones(b[0])
    best = [_score(_ones(own & b[0]), _ones(own), ones).max() for own in a[0]]
    return float(np.average(best, weights=a[1]))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1: overlap of bits beyond chance, each filter of the shorter chain with its best partner.

    Equal fingerprints give 1, also two empty ones; an empty and another give 0.
    """
    if a[0].shape == b[0].shape and np.array_equal(a[0], b[0]):
        return 1.0
    if not len(a[0]) or not len(b[0]):
        return 0.0
    if len(a[0]) == len(b[0]):
        return (_one_way(a, b) + _one_way(b, a)) / 2
    return _one_way(a, b) if len(a[0]) < len(b[0]) else _one_way(b, a)


def likenesses(some: list[tuple[np.ndarray, np.ndarray]], others: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
    """:func:`likeness` of each pair; those of two single filters are taken together."""
    single = [len(a[0]) == len(b[0]) == 1 for a, b in zip(some, others)]
    found = [0.0 if alone else likeness(a, b) for alone, a, b in zip(single, some, others)]
    at = np.flatnonzero(single)
    if len(at):
        a, b = (np.concatenate([side[i][0] for i in at]) for side in (some, others))
        weights = [np.concatenate([side[i][1] for i in at]) for side in (some, others)]
        score = _score(_ones(a & b), _ones(a), _ones(b))
        both = sum(score * w / w for w in weights) / 2
        for i, value in zip(at.tolist(), np.where((a == b).all(axis=1), 1.0, both).tolist()):
            found[i] = value
    return found


def written(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    """Number of filters, features of each, and the filters in base64."""
    filters, counts = fingerprint
    return f"{len(filters)}:{','.join(map(str, counts.tolist()))}:{base64.b64encode(filters.tobytes()).decode()}"


def _compared(ranks):
    """Walks each range in descending id with the text that follows; guests are what follows a range's last."""
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def results(ids, texts, nexts):
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, nexts)]
        # every next text but a range's last is the text of the row after it
        after = [i + 1 if i + 1 < len(texts) and texts[i + 1] is n else None for i, n in enumerate(nexts)]
        extra = [n for n, at in zip(nexts, after) if at is None]
        prints = fingerprints(pa.array(texts + extra, pa.large_string()), ranks.value)
        own, rest = prints[: len(texts)], iter(prints[len(texts) :])
        other = fingerprints(pa.array(edited, pa.large_string()), ranks.value)
        follow = [own[at] if at is not None else next(rest) for at in after]
        values = [
            ids,
            [len(t) for t in texts],
            [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            [written(x) for x in own],
            [written(x) for x in other],
            likenesses(own, other),
            likenesses(own, follow),
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, ready, size = None, ([], [], []), 0
        for batch in batches:
            for piece in kernels.blocks([batch], most=4 * READY_CHARS):
                for doc, text, part, guest in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "part", "guest"))):
                    text = text or ""
                    if waiting is not None and waiting[2] == part:
                        for held, value in zip(ready, (waiting[0], waiting[1], text)):
                            held.append(value)
                        size += len(text)
                        waiting = None
                    if not guest:
                        waiting = (doc, text, part)
                    if size > READY_CHARS:
                        yield results(*ready)
                        ready, size = ([], [], []), 0
        if ready[0]:
            yield results(*ready)

    return run


def _ranges(rows: DataFrame) -> tuple[list[int], dict[int, list[int]]]:
    """Lower ends of ranges of ids of about :data:`RANGE_ROWS` rows, and for ids the ranges they also follow.

    The driver holds one number for each range, :data:`MAX_RANGES` at most.
    """
    number = min(MAX_RANGES, rows.count() // RANGE_ROWS + 1)
    shares = [i / number for i in range(1, number)]
    ends = sorted(set(rows.approxQuantile("_d", shares, 1 / (4 * number)))) if shares else []
    cuts = [int(x) for x in ends]
    tops = rows.groupBy(_part(cuts)("_d").alias("part")).agg(F.max("_d").alias("top")).collect()
    tops = sorted((r["part"], r["top"]) for r in tops)
    follows: dict[int, list[int]] = {}
    for i, (part, _) in enumerate(tops):
        follows.setdefault(tops[i - 1][1], []).append(part)  # the lowest range is followed by the highest id
    return cuts, follows


def _part(cuts: list[int]):
    ends = np.array(cuts, np.int64)

    @F.pandas_udf(T.LongType())
    def part(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, ids.to_numpy(), "right"))

    return part


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and likeness to the edited and the next text.

    The edited text has its last half (rounded down) replaced by as many first characters of the next document in
    descending id; after the last comes the first. Texts are shuffled once, into ranges of ids; a
    range also gets the document that follows its last. Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    Null and empty texts have a fingerprint without filters. A null id comes after all others; rows with
    equal ids go by a hash of their texts. A single document follows itself.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(rarity(docs))
    own = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63) + 1))
    cuts, follows = _ranges(docs.select(own.alias("_d")))
    rows = docs.select("doc_id", "text", own.alias("_d"), F.xxhash64("text").alias("_t"))
    spark = docs.sparkSession
    pairs = [(d, part) for d, parts in follows.items() for part in parts]
    also = spark.createDataFrame(pairs, "_d bigint, part bigint")
    native = rows.withColumn("part", _part(cuts)("_d")).withColumn("guest", F.lit(False))
    guests = rows.join(F.broadcast(also), "_d").select(*rows.columns, "part", F.lit(True).alias("guest"))
    dealt = native.union(guests).repartition("part").sortWithinPartitions("part", "guest", F.desc("_d"), "_t")
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("doc_id", "text", "part", "guest").mapInArrow(_compared(ranks), schema)
