"""Merkle manifests of tables: hash trees in blocks of van Emde Boas layout."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.graph import join_ids
from tidemill.session import stage

BLOCK_LEVELS = 8  # levels of hashing inside a block, which so has 256 leaves at most
_HEX = "S64"
_ROW_BITS = 33  # of monotonically_increasing_id, below the number of the partition

#: One row per block: ``data`` holds its digests of 32 bytes in van Emde Boas order. ``n_leaves`` leaves and ``levels`` of
#: hashing give the shape; the block's root is a leaf of the layer above.
BLOCKS = "layer int, tree string, block bigint, n_leaves int, levels int, root string, data binary"


@cache
def addresses(levels: int) -> np.ndarray:
    """Place of each node of a complete tree in van Emde Boas order, by breadth-first number.

    The tree is split at half its height: the upper half is stored first, then the lower subtrees
    from left to right, all by the same rule. A node is found by arithmetic on the sizes of the halves it lies in.
    """
    height = levels + 1
    if height == 1:
        return np.zeros(1, np.int64)
    upper = height // 2
    top, bottom = addresses(upper - 1), addresses(height - upper - 1)
    out = np.empty(2**height - 1, np.int64)
    out[: len(top)] = top
    for level in range(upper, height):
        node = np.arange(2**level)
        below = level - upper
        tree, own = node >> below, node & (2**below - 1)
        out[2**level - 1 + node] = len(top) + tree * len(bottom) + bottom[2**below - 1 + own]
    return out


class Block:
    """An aligned subtree: leaves of one tree side by side, and all nodes over them."""

    def __init__(self, leaves: int, levels: int, data: np.ndarray):
        self.leaves, self.levels, self.data = leaves, levels, data

    @classmethod
    def build(cls, digests: list[str], levels: int) -> Block:
        """Hash neighbours level by level; a last node without a neighbour is hashed alone."""
        data = np.zeros(2 ** (levels + 1) - 1, _HEX)
        block = cls(len(digests), levels, data)
        row = [x.encode() for x in digests]
        for level in range(levels + 1):
            data[block.places(level)] = row
            row = [hashlib.sha256(b"".join(row[i : i + 2])).hexdigest().encode() for i in range(0, len(row), 2)]
        return block

    @classmethod
    def from_bytes(cls, leaves: int, levels: int, data: bytes) -> Block:
        raw = data.hex().encode()
        return cls(leaves, levels, np.frombuffer(raw, _HEX))

    def to_bytes(self) -> bytes:
        return b"".join(bytes.fromhex(x.decode().ljust(64, "0")) for x in self.data.tolist())

    def width(self, level: int) -> int:
        """Nodes ``level`` steps above the leaves."""
        return -(-self.leaves // 2**level)

    def places(self, level: int) -> np.ndarray:
        breadth = 2 ** (self.levels - level)
        return addresses(self.levels)[breadth - 1 : breadth - 1 + self.width(level)]

    @property
    def root(self) -> str:
        return self.data[0].decode()

    def siblings(self) -> list[list[str]]:
        """For every leaf, from the leaves up: the neighbour's digest after ``<`` or ``>``, the side it is on, or nothing."""
        paths: list[list[str]] = [[] for _ in range(self.leaves)]
        for level in range(self.levels):
            row = [x.decode() for x in self.data[self.places(level)].tolist()]
            for leaf, path in enumerate(paths):
                node = leaf >> level
                other = node ^ 1
                path.append("" if other >= len(row) else ("<" if other < node else ">") + row[other])
        return paths


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its path lead to."""
    for step in path:
        pair = leaf if not step else step[1:] + leaf if step[0] == "<" else leaf + step[1:]
        leaf = hashlib.sha256(pair.encode()).hexdigest()
    return leaf


def field(column: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` of many trees with their place ``at`` in their ``tree``, by ``order``.

    Leaves are dealt by ranges and numbered where they lie; only how many of a tree a partition has is summed over partitions.
    """
    last = leaves.withColumn("_last", F.monotonically_increasing_id())  # between equal leaves
    keys = ["tree", *order, "_last"]
    dealt = last.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id())
    part, row = F.shiftright("_m", _ROW_BITS), F.col("_m").bitwiseAND(F.lit(2**_ROW_BITS - 1))
    dealt = stage(dealt.withColumns({"_part": part, "_row": row}).drop("_m", "_last"), "ranked")
    held = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("tree").orderBy("_part")) - F.col("_n")
    held = stage(held.select("tree", "_part", (before - F.col("_first")).alias("_shift")), "held")
    rows = join_ids(dealt, held, ["tree", "_part"])
    return rows.withColumn("at", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")


def _singly(rows: pa.RecordBatch) -> Iterator[dict]:
    for i in range(rows.num_rows):
        yield rows.slice(i, 1).to_pylist()[0]


def _built(layer: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for row in _singly(rows):
                # the only block of a tree goes up to the tree's root, which may be nearer
                own = levels if row["total"] > 2**levels else (row["total"] - 1).bit_length()
                found = Block.build(row["digests"], own)
                out.append((layer, row["tree"], row["block"], found.leaves, own, found.root, found.to_bytes()))
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary()]
            names = ["layer", "tree", "block", "n_leaves", "levels", "root", "data"]
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def _layer(leaves: DataFrame, layer: int, levels: int) -> DataFrame:
    """Blocks over ``tree, at, digest``."""
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("total"))
    blocks = leaves.groupBy("tree", F.shiftright("at", levels).alias("block")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]).alias("digests")
    )
    rows = join_ids(blocks, stage(sizes, "sizes"), ["tree"])
    return stage(rows.mapInArrow(_built(layer, levels), BLOCKS), "blocks")


@dataclass
class Forest:
    """The layers of blocks over the leaves of many trees, and their roots ``tree, root``."""

    layers: list[DataFrame]
    roots: DataFrame
    levels: int

    def paths(self, above: DataFrame | None = None) -> DataFrame:
        """``tree, block, path`` for the blocks of the lowest layer: siblings from the block's root up.

        Goes down layer by layer. ``above`` has the ``tree, path`` of the trees' own roots.
        """
        tops = self.roots.select("tree", F.lit(0).cast("bigint").alias("block"), F.lit(None).cast("array<string>").alias("path"))
        if above is not None:
            tops = self.roots.select("tree", F.lit(0).cast("bigint").alias("block")).join(above, "tree")
        found = tops
        for blocks in reversed(self.layers[1:]):
            rows = blocks.join(found, ["tree", "block"])
            found = rows.select("tree", "block", "n_leaves", "levels", "data", "path").mapInArrow(
                _handed_down(self.levels), "tree string, block bigint, path array<string>"
            )
            # trees with fewer layers are not in this one
            found = stage(found.union(tops.join(blocks.select("tree").distinct(), "tree", "left_anti")), "paths")
        return found


def _handed_down(levels: int):
    """Path of every leaf of a block, which is the root of a block of the layer below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for row in _singly(rows):
                block = Block.from_bytes(row["n_leaves"], row["levels"], row["data"])
                first = row["block"] << levels
                out.extend((row["tree"], first + i, path + (row["path"] or [])) for i, path in enumerate(block.siblings()))
            kinds = [pa.string(), pa.int64(), pa.list_(pa.string())]
            columns = zip(*out) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["tree", "block", "path"])

    return run


def build(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> Forest:
    """Trees over the leaves ``tree, at, digest``; ``at`` counts from 0 in each tree.

    A layer's blocks of ``2**levels`` leaves are built apart; their roots are the leaves of the next layer,
    until every tree has one block. There are as many layers as the largest tree needs.
    """
    layers, roots, layer = [], None, 0
    while True:
        blocks = _layer(leaves, layer, levels)
        layers.append(blocks)
        most = blocks.groupBy("tree").agg(F.count("*").alias("n"))
        done = blocks.join(most.where("n = 1"), "tree").select("tree", "root")
        roots = done if roots is None else roots.union(done)
        if not most.where("n > 1").head(1):
            return Forest(layers, stage(roots, "roots"), levels)
        leaves = blocks.join(most.where("n > 1"), "tree").select("tree", F.col("block").alias("at"), F.col("root").alias("digest"))
        layer += 1


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proofs of the leaves of a block, and what they say about the rows as they are now."""
    for rows in batches:
        out = []
        for row in _singly(rows):
            block = Block.from_bytes(row["n_leaves"], row["levels"], row["data"])
            for leaf, path in zip(row["leaves"], block.siblings()):
                path = path + (row["path"] or [])
                proof = hashlib.sha256("".join(step[1:] for step in path).encode()).hexdigest()
                folded = fold(leaf["now"], path)
                out.append((leaf["doc_id"], leaf["digest"], row["subroot"], row["root"], proof, folded, folded == row["root"]))
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        columns = zip(*out) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def proofs(docs: DataFrame, now: dict[str, Column] | None = None, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Manifest of ``docs`` and a check of every row against it.

    A leaf is the SHA-256 of the row's ``doc_id, source, lang, n_chars, text``, each with its length before it. The leaves
    of a ``lang`` ascend by ``doc_id`` and are hashed in pairs to the language's subroot; subroots, by language,
    give the root. ``now`` replaces columns by what they hold at the time of the check; the row's path,
    made of the original neighbours, then leads to ``folded_root``, and ``verified`` says whether that is the root.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``; the proof is the neighbours from the leaf up, joined.

    Null languages come first, null ids first in their language; rows with equal ids go by their leaf, and
    equal rows in any order. An empty table has no rows and so no root.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    own, now = [F.col(c) for c in fields], now or {}
    changed = [now.get(c, F.col(c)) for c in fields]
    same = F.lit(True)
    for name, value in now.items():
        same &= F.col(name).eqNullSafe(value)
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))  # null sorts before all others
    hashed = docs.select(*fields, tree.alias("tree"), leaf_of(*own).alias("digest"))
    leaves = hashed.select(
        F.col("doc_id").cast("bigint"), "tree", "digest", F.when(same, F.col("digest")).otherwise(leaf_of(*changed)).alias("now")
    )
    placed = stage(_ranked(stage(leaves, "leaves"), ["doc_id", "digest"]), "placed")
    languages = build(placed.select("tree", "at", "digest"), levels)
    named = languages.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    over = stage(_ranked(named, ["name"]), "languages")
    whole = build(over.select("tree", "at", "digest"), levels)

    top = whole.layers[0].join(whole.paths(), ["tree", "block"]).select("tree", "block", "n_leaves", "levels", "data", "path")
    above = top.mapInArrow(_handed_down(levels), "tree string, block bigint, path array<string>")
    above = above.select(F.col("block").alias("at"), "path").join(over.select("at", "name"), "at")
    above = stage(above.select(F.col("name").alias("tree"), "path"), "above")
    root = whole.roots.first()
    subroots = stage(languages.roots.select("tree", F.col("root").alias("subroot")), "subroots")
    paths = join_ids(languages.paths(above), subroots, ["tree"])

    rows = placed.groupBy("tree", F.shiftright("at", levels).alias("block")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("at", "doc_id", "digest", "now"))),
            lambda x: F.struct(x["doc_id"].alias("doc_id"), x["digest"].alias("digest"), x["now"].alias("now")),
        ).alias("leaves")
    )
    rows = rows.join(languages.layers[0].drop("root", "layer"), ["tree", "block"]).join(paths, ["tree", "block"])
    rows = rows.withColumn("root", F.lit(root and root["root"]).cast("string"))
    kinds = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return rows.select("leaves", "n_leaves", "levels", "data", "path", "subroot", "root").mapInArrow(_checked, kinds)


def tampered_n_chars() -> Column:
    """``n_chars``, one more where 7 divides the checksum of the id's decimal digits."""
    hit = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 7 == 0
    return F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
