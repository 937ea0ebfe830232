"""Prefix trie of conversations, built in sorted shards under a skeleton of splitters."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.graph import join_ids
from tidemill.session import stage

SHARED_TURNS, GROUP = 4, 20  # fewer than so many turns come from the first conversation of a group of so many ids
SAMPLES_PER_SHARD = 40
TURN = 16  # bytes of a turn's digest; a path is the digests of a conversation's turns in order
IDS_PER_RUN = 4_096
WORDS = r"[^\x20\x09-\x0D]+"

NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
_FOUND = NODES + ", skeleton int, above int, shard int, run int, ids string"


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, path, words``: each conversation with its first turns taken from the first of its group.

    Conversation ``c`` has the first ``h`` turns of ``c - c % 20`` and its own turns after its first ``h``; ``h`` is the
    checksum of its decimal id modulo 4. ``path`` holds a digest of 16 bytes per turn, of role and text; ``words`` counts
    the words of each.

    Turns go by their number, null first, equal numbers by their digest; a null role or text is an empty one. Rows without a ``conv_id``
    belong to no conversation. Texts stay where they are read; a conversation's digests come together in one row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORDS)).alias("words")
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    own = rows.groupBy("conv_id").agg(ordered.alias("turns"))
    own = own.select("conv_id", F.transform("turns", lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))).alias("turns"))
    own = stage(own, "conversations")
    heads = own.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED_TURNS - 1).alias("head")
    )
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).cast("int")
    first = F.coalesce(F.slice("head", F.lit(1), h), F.array().cast("array<struct<digest:string,words:int>>"))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    whole = joined.select("conv_id", F.concat(first, rest).alias("turns"))
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda x: x["digest"]), "")).alias("path"),
        F.transform("turns", lambda x: x["words"]).alias("words"),
    )


def splitters(convs: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` pairs of path and id that cut the sorted conversations into shards of like numbers of turns.

    They come from a sample of some :data:`SAMPLES_PER_SHARD` conversations for each shard, chosen by a hash of the id. A path is
    cut to what tells it from the sample before it, so the skeleton stays small; where the sample has a path twice, the
    id goes on dividing, so that a conversation that very many ids share is dealt over shards too.
    """
    total = convs.count()
    share = min(1.0, SAMPLES_PER_SHARD * shards / max(1, total))
    chosen = F.pmod(F.xxhash64("conv_id", F.lit("shard")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = convs.where(chosen).select("path", "conv_id", (F.size("words") + 1).alias("weight"))
    order = Window.orderBy("path", "conv_id")  # the sample's size hangs on the number of shards only
    sums = sample.withColumns({"upto": F.sum("weight").over(order), "before": F.lag("path").over(order)})
    all_of = sums.agg(F.max("upto")).first()[0] or 0
    if shards < 2 or not all_of:
        return []
    place = F.floor(F.col("upto") * shards / all_of)
    begins = place > F.floor((F.col("upto") - F.col("weight")) * shards / all_of)
    found = []
    for row in sums.where(begins & (place < shards)).select("path", "conv_id", "before").collect():
        path, before = bytes(row["path"]), bytes(row["before"] or b"")
        if path == before:
            found.append((path, row["conv_id"]))
        else:
            same = _common(path, before)
            found.append((path[: TURN * (same + 1)], -(2**63)))
    return sorted(set(found))


def _common(one: bytes, two: bytes) -> int:
    """Number of turns that two paths begin with alike."""
    same, most = 0, min(len(one), len(two))
    while same < most and one[same : same + TURN] == two[same : same + TURN]:
        same += TURN
    return same // TURN


@dataclass
class Skeleton:
    """The trie of the splitters' paths, in preorder: its nodes are the only ones that lie in several shards."""

    cuts: list[tuple[bytes, int]]
    paths: list[bytes] = field(init=False)
    number: dict[bytes, int] = field(init=False)

    def __post_init__(self):
        found = {b""}
        for path, _ in self.cuts:
            found.update(path[:at] for at in range(TURN, len(path) + 1, TURN))
        self.paths = sorted(found)
        self.number = {path: i for i, path in enumerate(self.paths)}

    def parent(self, node: int) -> int:
        return self.number[self.paths[node][:-TURN]]


class _Frame:
    """A node on the path being read, with what is known of its subtree so far."""

    __slots__ = ("skeleton", "words", "least", "count", "children", "leaves", "saved", "ends", "ids", "runs", "waiting")

    def __init__(self, skeleton: int | None, words: int):
        self.skeleton, self.words = skeleton, words
        self.least, self.count, self.children, self.leaves, self.saved = 2**63, 0, 0, 0, 0
        self.ends, self.ids, self.runs, self.waiting = None, [], 0, []


class _Shard:
    """Nodes of one shard from its conversations in order, for :data:`_FOUND`.

    The stack holds the nodes of the last path. A node is done when a path leaves it; its row then waits for its parent's
    smallest member. Of a skeleton node the shard knows a part: what lies in no skeleton child.
    """

    def __init__(self, shard: int, skeleton: Skeleton):
        self.shard, self.skeleton = shard, skeleton
        self.last, self.stack = b"", [_Frame(0, 0)]
        self.rows: list[tuple] = []

    def add(self, path: bytes, conv: int, words: list[int]) -> None:
        same = _common(path, self.last)
        while len(self.stack) - 1 > same:
            self._close()
        for depth in range(same, len(path) // TURN):
            above = self.stack[-1].skeleton
            own = None if above is None else self.skeleton.number.get(path[: TURN * (depth + 1)])
            self.stack.append(_Frame(own, words[depth]))
        self.last = path
        frame = self.stack[-1]
        frame.count += 1
        frame.least = min(frame.least, conv)
        if frame.skeleton is None:
            if frame.ends is None:
                frame.ends = hashlib.sha256(str(conv).encode())
            else:
                frame.ends.update(f",{conv}".encode())
        else:
            frame.ids.append(conv)
            if len(frame.ids) == IDS_PER_RUN:
                self._run(frame)

    def _run(self, frame: _Frame) -> None:
        ids = ",".join(map(str, frame.ids))
        self.rows.append((None,) * 8 + (frame.skeleton, None, self.shard, frame.runs, ids))
        frame.ids, frame.runs = [], frame.runs + 1

    def _close(self) -> None:
        depth, frame = len(self.stack) - 1, self.stack.pop()
        for row in frame.waiting:
            self.rows.append((*row[:2], frame.least, *row[3:]))
        if frame.skeleton is not None:
            if frame.ids:
                self._run(frame)
            if frame.count:  # words of the node, in the place of the parent's id
                self.rows.append((frame.least, depth, frame.words, frame.count, frame.children, frame.leaves, frame.saved, None,
                                  frame.skeleton, None, self.shard, None, None))
            elif depth:
                self.rows.append((None, depth, frame.words, 0, 0, 0, 0, None, frame.skeleton, None, self.shard, None, None))
            return
        parent = self.stack[-1]
        saved = frame.saved + (frame.count - 1) * frame.words
        leaves = frame.leaves if frame.children else 1
        ends = (frame.ends or hashlib.sha256()).hexdigest()
        row = (frame.least, depth, None, frame.count, frame.children, leaves, saved, ends, None, parent.skeleton, None, None, None)
        if parent.skeleton is None:
            parent.waiting.append(row)
        else:
            self.rows.append(row)
        parent.count += frame.count
        parent.least = min(parent.least, frame.least)
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved

    def end(self) -> None:
        while self.stack:
            self._close()

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _FOUND.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _sharded(cuts: list[tuple[bytes, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys = zip(rows.column("path").to_pylist(), rows.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(cuts, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *rows.columns], ["shard", *rows.schema.names])

    return run


def _local(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work: _Shard | None = None
        for rows in batches:
            for shard, conv, path, words in zip(*(rows.column(c).to_pylist() for c in ("shard", "conv_id", "path", "words"))):
                if work is None or work.shard != shard:
                    before = work
                    work = _Shard(shard, skeleton)
                    if before:
                        before.end()
                        yield _batch(before.taken())
                work.add(path, conv, words)
            if work and len(work.rows) > 10_000:
                yield _batch(work.taken())
        if work:
            work.end()
            yield _batch(work.taken())

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksum of the ids of each skeleton node, from its runs in order."""
    node, state, out = None, None, []
    for rows in batches:
        for own, ids in zip(rows.column("skeleton").to_pylist(), rows.column("ids").to_pylist()):
            if own != node:
                if state:
                    out.append((node, state.hexdigest()))
                node, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state:
        out.append((node, state.hexdigest()))
        columns = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string()))], ["skeleton", "ends"])


def _reduced(skeleton: Skeleton, parts: list) -> list[tuple]:
    """Rows of the skeleton's nodes: sums go from each node to its parent, last nodes of the preorder first."""
    count = len(skeleton.paths)
    least, total, children = [2**63] * count, [0] * count, [0] * count
    leaves, saved, words = [0] * count, [0] * count, [0] * count
    for x in parts:
        at = x["skeleton"]
        least[at] = 2**63 if x["least"] is None else x["least"]
        total[at], children[at], leaves[at], saved[at], words[at] = x["n"], x["children"], x["leaves"], x["saved"], x["words"]
    for at in range(count - 1, 0, -1):
        leaves[at] = leaves[at] if children[at] else 1
        saved[at] += (total[at] - 1) * words[at]
        up = skeleton.parent(at)
        least[up] = min(least[up], least[at])
        for sums in (total, leaves, saved):
            sums[up] += sums[at]
        children[up] += 1
    leaves[0] = leaves[0] if children[0] else 1
    depth = [len(path) // TURN for path in skeleton.paths]
    up = [None] + [least[skeleton.parent(at)] for at in range(1, count)]
    return [(at, *x) for at, x in enumerate(zip(least, depth, up, total, children, leaves, saved)) if total[at]]


def prefix_trie(turns: DataFrame, shards: int | None = None) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations (:func:`rebuilt`), one row each.

    A node of depth ``d`` is a distinct sequence of ``d`` first turns, by 128-bit digests of role and text; the root has none.
    Its members are the conversations that begin with it. Returns the smallest member ``conv_id``, ``depth``, the parent's
    ``parent_conv_id``, ``n_convs`` members, ``n_children``, ``n_leaves`` below it, ``saved_tokens`` (over its subtree, words of a node's last
    text for each member but one) and ``ends_sha256`` of the members that end there.

    1. Splitters from a sample cut the conversations, sorted by path and id, into ``shards`` (as many as the session's shuffle partitions).
    2. A node that is no prefix of a splitter has all its members in one shard, which finishes it in one pass over its sorted rows.
    3. Prefixes of splitters, the skeleton, are known to every task. A shard gives its part of such a node; parts are summed, and the
       skeleton, as small as the number of splitters makes it, is reduced from its deepest nodes up.

    Conversations without turns end at the root. A table without conversations has no node.
    """
    spark = turns.sparkSession
    convs = stage(rebuilt(turns), "rebuilt")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    skeleton = Skeleton(splitters(convs, shards))
    dealt = convs.mapInArrow(_sharded(skeleton.cuts), "shard int, conv_id bigint, path binary, words array<int>")
    dealt = dealt.repartitionById(len(skeleton.cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = stage(dealt.mapInArrow(_local(skeleton), _FOUND), "nodes")

    parts = found.where("skeleton is not null and ids is null").groupBy("skeleton").agg(
        F.min("conv_id").alias("least"), F.max("parent_conv_id").alias("words"), F.sum("n_convs").alias("n"),
        F.sum("n_children").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
    )
    rows = _reduced(skeleton, parts.collect())
    names = "skeleton int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    over = stage(spark.createDataFrame(rows, names), "skeleton")
    runs = found.where("ids is not null").select("skeleton", "shard", "run", "ids")
    runs = runs.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "run")
    ends = runs.mapInArrow(_hashed, "skeleton int, ends string")
    none = hashlib.sha256().hexdigest()
    tops = over.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(none)))

    columns = [x.split()[0] for x in NODES.split(", ")]
    rest = found.where("skeleton is null")
    inner = rest.where("above is null").select(*columns)
    names = over.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("up"))
    hanging = join_ids(rest.where("above is not null"), stage(names, "above"), ["above"])
    hanging = hanging.withColumn("parent_conv_id", F.col("up")).select(*columns)
    return tops.select(*columns).union(inner).union(hanging)
