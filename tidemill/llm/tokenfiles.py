"""Token ids of all documents in files of Re-Pair blocks, and reading them back."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm import repair, wordbpe
from tidemill.llm.graph import join_ids
from tidemill.session import new_folder, stage

BLOCK_IDS = 1 << 20  # ids under one grammar
END_ID = 2
_BATCH_BYTES = 4 << 20

#: A row of the files is a block. ``part`` and ``block`` order the blocks, ``before`` is the number of ids of
#: the part before it. The arrays have an entry for each document in the block: its id, its number of ids here, which piece of it this is, and whether
#: it ends here. ``low`` and ``high`` bound the ids of documents.
BLOCKS = (
    "part int, block int, before bigint, n_tokens bigint, first_document bigint, low bigint, high bigint, "
    "doc_id array<bigint>, count array<int>, piece array<int>, ends array<boolean>, grammar binary"
)


def _encoded(vocabulary: str, end_id: int, block_ids: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordbpe.encoder(vocabulary)
        end = np.array([end_id], np.uint32)
        out, held = [], 0

        def batch():
            columns = zip(*out)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            names = ["doc_id", "row", "piece", "ends", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for rows in batches:
            docs, numbers = rows.column("doc_id").to_pylist(), rows.column("row").to_pylist()
            turns = itertools.chain(encoder.encode(rows.column("text")), [(len(docs), None)])
            text, ids = next(turns)
            for i, key in enumerate(zip(docs, numbers)):
                piece, rest = 0, []
                while text == i:
                    rest.append(ids)
                    while sum(map(len, rest)) >= block_ids:
                        whole = np.concatenate(rest)
                        out.append((*key, piece, False, whole[:block_ids].astype(kind).tobytes()))
                        piece, rest, held = piece + 1, [whole[block_ids:]], held + len(out[-1][-1])
                        if held > _BATCH_BYTES:
                            yield batch()
                            out, held = [], 0
                    text, ids = next(turns)
                raw = np.concatenate((*rest, end)).astype(kind).tobytes()
                out.append((*key, piece, True, raw))
                held += len(raw)
                if held > _BATCH_BYTES:
                    yield batch()
                    out, held = [], 0
        if out:
            yield batch()

    return run


def _compressed(first: int, block_ids: int, kind: str):
    """Blocks of the sorted pieces of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block = before = documents = held = 0
        entries: list[tuple] = []
        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int32()), *((c, pa.int64()) for c in ("before", "n_tokens", "first_document", "low", "high")),
             ("doc_id", pa.list_(pa.int64())), ("count", pa.list_(pa.int32())), ("piece", pa.list_(pa.int32())),
             ("ends", pa.list_(pa.bool_())), ("grammar", pa.binary())]
        )

        def flush():
            docs, pieces, ends, raw = zip(*entries)
            ids = np.concatenate([np.frombuffer(x, kind) for x in raw])
            known = [x for x in docs if x is not None]
            opened = documents - sum(p == 0 for p in pieces) - (pieces[0] > 0)
            row = [part, block, before, len(ids), opened, min(known, default=None), max(known, default=None), docs,
                   [len(x) // np.dtype(kind).itemsize for x in raw], pieces, ends, repair.compress(ids, first).to_bytes()]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema), len(ids)

        for rows in batches:
            columns = [rows.column(c) for c in ("doc_id", "piece", "ends", "ids")]
            for entry in zip(*(c.to_pylist() for c in columns)):
                size = len(entry[3]) // np.dtype(kind).itemsize
                if entries and held + size > block_ids:
                    found, count = flush()
                    yield found
                    entries, held, block, before = [], 0, block + 1, before + count
                documents += entry[1] == 0
                entries.append(entry)
                held += size
        if entries:
            yield flush()[0]

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str = wordbpe.VOCABULARY,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the token ids of all texts to ``path``, in ascending order of ``doc_id``.

    Texts are encoded where they are read; their ids, cut into pieces of ``block_ids`` at most, are dealt by ranges of ids and sorted, and
    every ``block_ids`` ids of a range get a Re-Pair grammar of their own (:mod:`tidemill.llm.repair`). No task holds more than a block and a text.

    A null or empty text is ``end_id`` alone. Null ids come first; rows with equal ids keep the order they are read in.
    A long text is encoded in slices and may go on over several blocks; only a single word is never cut. An empty table gives no block.
    """
    size = wordbpe.encoder(vocabulary).size
    kind = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.monotonically_increasing_id().alias("row"))
    pieces = rows.mapInArrow(
        _encoded(vocabulary, end_id, block_ids, kind), "doc_id bigint, row bigint, piece int, ends boolean, ids binary"
    )
    ordered = stage(pieces, "tokens").repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row", "piece")
    ordered.mapInArrow(_compressed(max(size, end_id + 1), block_ids, kind), BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksums and places of the documents of blocks."""
    for rows in batches:
        for row in range(rows.num_rows):
            own = {c: rows.column(c)[row].as_py() for c in ("part", "first_document", "begin", "doc_id", "count", "piece", "ends")}
            ids = repair.Grammar.from_bytes(rows.column("grammar")[row].as_py()).expand()
            count = np.array(own["count"], np.int64)
            stop = np.cumsum(count)
            crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip((stop - count).tolist(), stop.tolist())]
            piece = np.array(own["piece"], np.int64)
            number = own["first_document"] + np.cumsum(piece == 0) - (piece[0] == 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own["doc_id"], pa.int64()), pa.array(own["begin"] + stop - count), pa.array(count), pa.array(crc, pa.int64()),
                 pa.array(np.full(len(count), own["part"], np.int32)), pa.array(number),
                 pa.array((piece == 0) & np.array(own["ends"], bool))],
                ["doc_id", "start", "n_tokens", "ids_crc32", "part", "number", "whole"],
            )


def _joined(pieces: pd.DataFrame) -> pd.DataFrame:
    """One document from its pieces; the checksum of two runs follows from theirs and the second's length."""
    pieces = pieces.sort_values("start")
    total = 0
    for count, crc in zip(pieces["n_tokens"].tolist(), pieces["ids_crc32"].tolist()):
        zeros = bytes(4 * count)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    out = pieces[["doc_id", "start", "n_tokens", "ids_crc32"]].head(1).copy()
    out["n_tokens"], out["ids_crc32"] = pieces["n_tokens"].sum(), total
    return out


def documents(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the blocks that hold its ids.

    ``start`` is the number of ids of all documents before it, ``ids_crc32`` the checksum of its ids as
    little-endian unsigned 32-bit numbers.
    """
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    placed = join_ids(blocks, stage(offsets, "offsets"), ["part"])
    placed = placed.withColumn("begin", F.col("offset") + F.col("before"))
    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    found = placed.select("part", "first_document", "begin", "doc_id", "count", "piece", "ends", "grammar").mapInArrow(
        _decoded, kinds + ", part int, number bigint, whole boolean"
    )
    found = stage(found, "documents")
    cut = found.where("not whole").groupBy("part", "number").applyInPandas(_joined, kinds)
    return found.where("whole").select("doc_id", "start", "n_tokens", "ids_crc32").union(cut)


def _chosen(wanted: set[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                grammar, stop = repair.Grammar.from_bytes(row["grammar"]), np.cumsum(row["count"]).tolist()
                out = [
                    (doc, row["part"], row["block"], i, grammar.span(e - n, e).tolist())
                    for i, (doc, n, e) in enumerate(zip(row["doc_id"], row["count"], stop))
                    if doc in wanted
                ]
                if out:
                    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
                    names = ["doc_id", "part", "block", "at", "ids"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def token_ids(blocks: DataFrame, wanted: list[int]) -> DataFrame:
    """Ids of a few documents, piece by piece: ``doc_id, part, block, at, ids``, in the order of the last three but ``ids``.

    Only blocks whose bounds hold a wanted id are read, and of those only the symbols that make up its ids are expanded.
    """
    near = F.lit(False)
    for doc in sorted(set(wanted)):
        near |= (F.col("low") <= doc) & (F.col("high") >= doc)
    rows = blocks.where(near).select("part", "block", "doc_id", "count", "grammar")
    return rows.mapInArrow(_chosen(set(wanted)), "doc_id bigint, part int, block int, at int, ids array<bigint>")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the ids of ``docs`` to a new folder and tell from its files what :func:`documents` does."""
    path = new_folder(docs.sparkSession, "token-files")
    write_tokens(docs, path, **options)
    return documents(read_blocks(docs.sparkSession, path))
