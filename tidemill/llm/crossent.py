"""Cross-entropy difference of documents between two n-gram models."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import kernels
from tidemill.session import stage

BLOCK_BYTES = 4 << 20  # of text whose n-grams are asked for together
BUCKET_BYTES = 16 << 20  # of text for each bucket of n-grams
LEAST_BUCKET_BITS = 6
TEXTS = -1  # bucket of the rows that carry a block's texts
BEGIN = 1  # stands before the first word of a text
WORD, CONTEXT, PAIR = 0, 1, 2  # kinds of n-gram, in the two lowest bits of its name
NAME_BITS = 40  # within a bucket, some million n-grams: two of them share a name with a probability under 1e-5 each
SMOOTH, TRUST = 0.5, 2.0
_ZSTD = pa.Codec("zstd", 1)
_ROWS = "block bigint, bucket int, size int, data binary"
_ANSWERS = f"{_ROWS}, target_words bigint, words bigint, vocabulary bigint"


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of small whole numbers, byte by byte: the bytes that are mostly zero cost nothing."""
    raw = np.ascontiguousarray(np.stack(columns).astype(np.int64)).view(np.uint8)
    return _ZSTD.compress(raw.reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes(), asbytes=True)


def _unpacked(raw: bytes, size: int, columns: int) -> np.ndarray:
    flat = np.frombuffer(_ZSTD.decompress(raw, size * columns * 8, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(columns, 8, size).transpose(0, 2, 1)).view(np.int64)[:, :, 0]


class Block:
    """The words of a block of texts, and its n-grams by name.

    A name is the n-gram's bucket and :data:`NAME_BITS` more, so that the names of one bucket tell its n-grams apart however
    many buckets there are. ``places`` has for each word the places of the word, of the one before as a
    context, and of the pair among the sorted ``names``.
    """

    def __init__(self, column: pa.Array, bits: int):
        parts = [(words.hashes(), words.counts()) for words, _ in kernels.slices(column, 0, lower=True)]
        own = np.concatenate([hashes for hashes, _ in parts])
        self.texts = len(column)
        self.number = np.sum([counts for _, counts in parts], axis=0) if self.texts == 1 else parts[0][1]
        self.doc = np.repeat(np.arange(self.texts), self.number)
        word, words = pd.factorize(own)
        begins = np.ones(len(own), bool)
        begins[1:] = self.doc[1:] != self.doc[:-1]
        context = np.full(len(own), len(words))
        context[1:] = word[:-1]
        context[begins] = len(words)
        pair, pairs = pd.factorize(context * (len(words) + 1) + word)
        words = np.append(words, np.uint64(BEGIN))
        first, second = np.divmod(pairs, len(words))
        pairs = words[first] * np.uint64(kernels.WORD_BASE) + words[second]
        names = np.concatenate([self._named(v, kind, bits) for kind, v in ((WORD, words[:-1]), (CONTEXT, words), (PAIR, pairs))])
        order = np.argsort(names, kind="stable")
        self.names = names[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.places = rank[word], rank[len(words) - 1 + context], rank[2 * len(words) - 1 + pair]

    @staticmethod
    def _named(values: np.ndarray, kind: int, bits: int) -> np.ndarray:
        name = kernels.mix(values, 70 + kind) >> np.uint64(64 - bits - NAME_BITS)
        return (name & np.uint64(2**64 - 4) | np.uint64(kind)).astype(np.int64)

    def totals(self, chosen: np.ndarray) -> np.ndarray:
        """How often each n-gram stands in the chosen texts."""
        there = chosen[self.doc]
        return sum(np.bincount(p[there], minlength=len(self.names)) for p in self.places)

    def own(self) -> list[np.ndarray]:
        """For each word, how often it, its context and the pair stand in its own text."""
        found = []
        for place in self.places:
            at, _ = pd.factorize(self.doc * len(self.names) + place)
            found.append(np.bincount(at)[at] if len(at) else at)
        return found


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts in blocks, a row for each; its number is any, and fixed by what is written."""
    for batch in kernels.blocks(batches, most=BLOCK_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        yield _batch([(uuid.uuid4().int >> 65, TEXTS, 0, sink.getvalue().to_pybytes())])


def _texts(raw: pa.Scalar) -> tuple[pa.Table, np.ndarray]:
    """Rows of a block, and which of them are of the target corpus."""
    texts = pa.ipc.open_stream(raw.as_py()).read_all().combine_chunks()
    return texts, texts.column("is_target").to_numpy().astype(bool)


def _asked(bits: int):
    """For each block and bucket its n-grams there, with how often they stand in the block, of both corpora."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column("block").to_pylist(), batch.column("data")):
                texts, target = _texts(raw)
                block = Block(texts.column("text").combine_chunks(), bits)
                counts = block.totals(target), block.totals(np.ones(block.texts, bool))
                buckets, at = np.unique(block.names >> NAME_BITS, return_index=True)
                rows = []
                for bucket, start, end in zip(buckets.tolist(), at.tolist(), [*at[1:].tolist(), len(block.names)]):
                    steps = np.diff(block.names[start:end], prepend=bucket << NAME_BITS)
                    rows.append((number, bucket, end - start, _packed(steps, counts[0][start:end], counts[1][start:end])))
                yield _batch(rows)

    return run


def _batch(rows: list[tuple], totals: int = 0) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * totals]
    names = ["block", "bucket", "size", "data", "target_words", "words", "vocabulary"][: len(kinds)]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _answered(table: pa.Table) -> pa.Table:
    """The counts in all texts of the n-grams each block asked for in one bucket, in the order it asked."""
    sizes = table.column("size").to_pylist()
    asked = [_unpacked(raw.as_py(), n, 3) for raw, n in zip(table.column("data"), sizes)]
    at, names = pd.factorize(np.concatenate([np.cumsum(steps) for steps, _, _ in asked]))
    word = names & 3 == WORD
    totals, sums = [], []
    for column in (1, 2):
        found = np.bincount(at, np.concatenate([part[column] for part in asked])).astype(np.int64)
        sums.append(int(found[word].sum()))
        totals.append(found[at])
    sums.append(int(word.sum()))
    rows, end = [], 0
    for block, bucket, n in zip(table.column("block").to_pylist(), table.column("bucket").to_pylist(), sizes):
        own = sums if not rows else (0, 0, 0)  # the bucket's words, with its first row
        rows.append((block, bucket, n, _packed(*(t[end : end + n] for t in totals)), *own))
        end += n
    return pa.Table.from_batches([_batch(rows, totals=3)])


def _scored(bits: int, words: tuple[int, int], vocabulary: int):
    """Mean losses of a block's texts, each under the models of all texts but itself."""

    def losses(block: Block, own: list, counts: np.ndarray, total: int, scale: float, held: np.ndarray) -> np.ndarray:
        rest = scale * (total - np.where(held, block.number, 0))[block.doc]
        seen = [scale * (counts[p] - np.where(held[block.doc], o, 0)) for p, o in zip(block.places, own)]
        share = (seen[WORD] + SMOOTH) / (rest + SMOOTH * (vocabulary + 1))
        loss = -np.log((seen[PAIR] + TRUST * share) / (seen[CONTEXT] + TRUST))
        return np.bincount(block.doc, loss, minlength=block.texts) / np.maximum(block.number, 1)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        sizes, data = table.column("size").to_pylist(), table.column("data")
        texts, target = _texts(data[0])
        block = Block(texts.column("text").combine_chunks(), bits)
        answers = [_unpacked(data[i].as_py(), sizes[i], 2) for i in range(1, len(sizes))]
        counts = np.concatenate(answers, axis=1) if answers else np.zeros((2, 0), np.int64)
        own, number = block.own(), block.number
        scale = words[1] / words[0] if words[0] else 0.0
        means = [
            losses(block, own, counts[0], words[0], scale, target),
            losses(block, own, counts[1], words[1], 1.0, np.ones(block.texts, bool)),
        ]
        none = (number == 0) | (not words[0])
        values = [pa.array(v, pa.float64(), mask=none) for v in (*means, means[0] - means[1])]
        return pa.Table.from_arrays(
            [texts.column("doc_id").cast(pa.int64()), pa.array(number, pa.int64()), *values],
            ["doc_id", "n_tokens", "target_loss", "background_loss", "difference"],
        )

    return run


def score(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, difference`` of every row; losses per word in nats.

    The target corpus are the rows of ``docs`` whose id is in ``targets (doc_id)``, the background all rows. Both
    models count words and word pairs exactly, share the vocabulary of all rows and one smoothing: a word after
    another has ``(pairs + TRUST * share) / (context + TRUST)``, its share ``(count + SMOOTH)`` over all words and one
    unseen. The target's counts are scaled to the background's number of words, so that the smoothing
    weighs the same in both. Every row is scored by the models of the other rows, so neither has read it.

    Blocks of texts ask for the counts of their n-grams bucket by bucket; the task that has a bucket adds up what all blocks
    bring and answers each. Buckets grow in number with the corpus, no task or driver holds a model, and a
    frequent word pair is one entry for each block.

    A negative difference means a text more like the target corpus. Null, empty and wordless texts have
    no words and null losses; without any target text the two models are not comparable and losses are null too.
    Repeated rows are scored each, and each is another row to the other; a null id is in no target.
    """
    kernels.small_batches(docs.sparkSession)
    marked = targets.where("doc_id is not null").select("doc_id").distinct().withColumn("is_target", F.lit(True))
    ids = docs.select("doc_id", "text")
    few = marked.count() <= 1_000_000
    rows = ids.join(F.broadcast(marked) if few else marked.hint("shuffle_merge"), "doc_id", "left")
    rows = rows.select("doc_id", "text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    size = ids.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(LEAST_BUCKET_BITS, int(np.ceil(np.log2(max(size, 1) / BUCKET_BYTES))))
    blocks = stage(rows.mapInArrow(_stored, _ROWS), "blocks")
    asked = blocks.select("block", "data").mapInArrow(_asked(bits), _ROWS)
    answers = stage(asked.groupBy("bucket").applyInArrow(_answered, _ANSWERS), "counts")
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("target_words", "words", "vocabulary")]
    *words, vocabulary = answers.agg(*sums).first()
    both = blocks.union(answers.select(*blocks.columns))
    return both.groupBy("block").applyInArrow(
        _scored(bits, tuple(words), vocabulary),
        "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, difference double",
    )
