"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import kernels
from tidemill.llm.graph import BROADCAST_IDS, components, join_ids
from tidemill.session import scratch, stage

BANDS, BAND_ROWS, BITS = 40, 6, 4
HASHES = BANDS * BAND_ROWS
BLOCK_NODES = 2_048  # nodes of one bucket compared against as many others in one task
PAIRS_PER_LEADER = 1_000

_SEEDS = np.random.default_rng(4_004)
_FACTORS = (_SEEDS.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_SHIFTS = _SEEDS.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
_COLUMNS = 512


def minima(shingles: np.ndarray) -> np.ndarray:
    """Least value of each of the :data:`HASHES` hash functions over a set of shingles."""
    own = (kernels.mix(shingles, 7) >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(own), _COLUMNS):
        np.minimum(best, (_FACTORS * own[at : at + _COLUMNS] + _SHIFTS).min(axis=1), out=best)
    return best


def band_keys(best: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of minima; the band's number is part of it."""
    rows = best.astype(np.uint64).reshape(BANDS, BAND_ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in rows.T:
        keys = kernels.mix(keys * np.uint64(kernels.WORD_BASE) + column)
    return keys.view(np.int64)


def low_bits(best: np.ndarray) -> np.ndarray:
    """The :data:`BITS` low bits of each minimum (stirred first), two minima to a byte."""
    kept = ((best ^ (best >> np.uint32(15))) & np.uint32(2**BITS - 1)).astype(np.uint8)
    return kept[0::2] << 4 | kept[1::2]


def estimated_similarity(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Jaccard similarity from packed low bits, corrected for chance agreement."""
    differ = others ^ one
    same = ((differ & 15) == 0).sum(axis=1) + ((differ >> 4) == 0).sum(axis=1)
    chance = 0.5**BITS
    return (same / HASHES - chance) / (1 - chance)


def doubt(threshold: float) -> float:
    """Estimates below this belong to pairs under the threshold: 5.5 standard errors of room."""
    chance = 0.5**BITS
    agree = chance + (1 - chance) * threshold
    return threshold - 5.5 * math.sqrt(agree * (1 - agree) / HASHES) / (1 - chance)


def node_of(shingles: np.ndarray) -> bytes:
    """128-bit name of a set: documents with equal sets are one node."""
    sums = [int(kernels.mix(shingles, salt).sum(dtype=np.uint64)) for salt in (11, 12)]
    sums[0] = (sums[0] + len(shingles)) % 2**64
    return sums[0].to_bytes(8, "big") + sums[1].to_bytes(8, "big")


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            nodes, counts, keys, packed = [], [], [], []
            for shingles in kernels.shingle_sets(batch.column("text"), size):
                nodes.append(node_of(shingles))
                counts.append(len(shingles))
                if len(shingles):
                    best = minima(shingles)
                    keys.append(band_keys(best))
                    packed.append(low_bits(best).tobytes())
                else:
                    keys.append(np.zeros(0, np.int64))
                    packed.append(b"")
            bands = kernels.list_column(np.concatenate(keys), np.array([len(k) for k in keys]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("_t"), kernels.binary_column(nodes),
                 pa.array(counts, pa.int64()), bands, kernels.binary_column(packed)],
                ["doc_id", "_t", "node", "n_shingles", "bands", "packed"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            nodes, sets = [], []
            wanted = batch.column("node").to_pylist()
            for node, shingles in zip(wanted, kernels.shingle_sets(batch.column("text"), size)):
                if node_of(shingles) == node:  # else another row with the same id
                    nodes.append(node)
                    sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays(
                [kernels.binary_column(nodes), kernels.binary_column(sets)], ["node", "shingles"]
            )

    return run


def _shared(one: np.ndarray, two: np.ndarray) -> int:
    return len(np.intersect1d(one, two, assume_unique=True))


def _confirm(percent: int):
    """Pairs that their packed bits do not rule out and their full sets confirm."""
    least = doubt(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, keep = batch.column("set_a"), batch.column("set_b"), []
            packed = [np.stack([np.frombuffer(x, np.uint8) for x in batch.column(c).to_pylist()]) for c in ("packed_a", "packed_b")]
            likely = estimated_similarity(*packed) >= least
            for a, b, worth in zip(one, two, likely.tolist()):
                if not worth:
                    keep.append(False)
                    continue
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = _shared(a, b)
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the threshold.

    ``a`` may stand in very many pairs: its pairs are dealt over slices of about
    :data:`PAIRS_PER_LEADER`, and its set goes once to each slice.
    """
    often = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_PER_LEADER).cast("int").alias("slices"))
    dealt = pairs.join(often, "a").withColumn("slice", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int"))
    right = dealt.drop("slices").join(sets.toDF("b", "set_b", "packed_b"), "b")
    left = sets.toDF("a", "set_a", "packed_a").join(often, "a")
    left = left.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    both = right.join(left, ["a", "slice"]).select("a", "b", "set_a", "set_b", "packed_a", "packed_b")
    return both.mapInArrow(_confirm(percent), "a binary, b binary")


def _across(least: float):
    """Of one bucket, the nodes with partners in other components that may reach the threshold.

    Gives ``node, root, partners``, the partners' names joined. The left side has nodes outside the bucket's largest component,
    the right side any; a pair of two of the first kind is taken from the side with the smaller name. A pair that shares several
    buckets is given by the one of its first common band only.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        partners: dict[bytes, list[bytes]] = {}
        if len(left) and len(right):
            packed = np.stack([np.frombuffer(x, np.uint8) for x in right["packed"]])
            bands = np.stack([np.asarray(x, np.int64) for x in right["bands"]])
            roots, names = right["root"].to_numpy(object), right["node"].to_numpy(object)
            key, main = rows["key"].iloc[0], right["main"].to_numpy(bool)
            for node, root, own, keys in zip(left["node"], left["root"], left["packed"], left["bands"]):
                near = estimated_similarity(np.frombuffer(own, np.uint8), packed) >= least
                near &= (roots != root) & (main | (names > node))
                at = np.flatnonzero(near)
                if len(at):
                    common = bands[at] == np.asarray(keys, np.int64)
                    first = at[bands[at, common.argmax(axis=1)] == key]
                    for other in names[first]:
                        partners.setdefault(node, []).append(other)
                        partners.setdefault(other, [])
        root_of = dict(zip(rows["node"], rows["root"]))
        group = [rows[c].iloc[0] for c in ("key", "i", "j")]
        found = [(*group, node, root_of[node], b"".join(others)) for node, others in partners.items()]
        return pd.DataFrame(found, columns=["key", "i", "j", "node", "root", "partners"])

    return run


def _confirm_across(percent: int):
    """Links between components, from one bucket's nodes with their full sets and partners."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = {n: np.frombuffer(x, np.uint64) for n, x in zip(rows["node"], rows["shingles"])}
        root_of = dict(zip(rows["node"], rows["root"]))
        linked: dict[tuple[bytes, bytes], tuple[bytes, bytes]] = {}
        for node, names in zip(rows["node"], rows["partners"]):
            for at in range(0, len(names), 16):
                other = names[at : at + 16]
                ends = (root_of[node], root_of[other])
                if ends not in linked:
                    both = _shared(sets[node], sets[other])
                    if 100 * both >= percent * (len(sets[node]) + len(sets[other]) - both):
                        linked[ends] = (node, other)
        return pd.DataFrame(list(linked.values()), columns=["a", "b"])

    return run


def _cross_links(
    members: DataFrame, nodes: DataFrame, sets: DataFrame, roots: DataFrame, percent: int
) -> DataFrame:
    """Links between different components: all candidate pairs, block by block in their buckets.

    In a bucket the nodes of its largest component meet the others only, so they are dealt to blocks once, however many they
    are; the others, mostly few, are copied to each of these blocks. Pairs stay inside the tasks that compare them.
    """
    placed = members.join(roots, "node")
    parts = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(F.count("*").alias("roots"), F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("main"))
    blocks = lambda n: F.ceil(n / BLOCK_NODES).cast("int")
    mixed = mixed.where("roots > 1").select(
        "key", F.col("main.root").alias("largest"), blocks(F.col("size")).alias("right"), blocks(F.col("size") - F.col("main.n")).alias("left")
    )
    rows = placed.join(mixed, "key").join(nodes.select("node", "packed", "bands"), "node")
    main = F.col("root") == F.col("largest")
    home = lambda parts: F.pmod(F.xxhash64("node"), F.col(parts)).cast("int")

    def dealt(column: str) -> Column:
        return F.sequence(F.lit(0), F.col(column) - 1)

    right = F.transform(dealt("left"), lambda j: F.struct(home("right").alias("i"), j.alias("j"), F.lit(1).alias("side")))
    left = F.transform(dealt("right"), lambda i: F.struct(i.alias("i"), home("left").alias("j"), F.lit(0).alias("side")))
    rows = rows.withColumn("m", F.explode(F.when(main, right).otherwise(F.concat(right, left))))
    rows = rows.select("key", "node", "root", "packed", "bands", main.alias("main"), "m.i", "m.j", "m.side")
    kinds = "key bigint, i int, j int, node binary, root binary, partners binary"
    near = rows.groupBy("key", "i", "j").applyInPandas(_across(doubt(percent / 100)), kinds)
    whole = stage(near, "cross").join(sets.drop("packed"), "node")
    return whole.groupBy("key", "i", "j").applyInPandas(_confirm_across(percent), "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by word shingles: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when their sets of ``words``-word shingles (A-Z in lower case) have
    ``100 * common >= percent * together``. Method: :data:`HASHES` minima per set; documents that
    agree in all minima of one of :data:`BANDS` bands are candidates; their low bits, packed, give
    an estimate corrected for chance, and what that cannot rule out is confirmed on the full sets.

    Documents with equal sets are one node. In every bucket the node that shares most buckets with others
    and one chosen by hash are confirmed against the rest; then only pairs of nodes that are still in different
    components are looked at, all of them, so that no link that joins two groups is
    missing while groups of thousands need no square of pairs.

    ``component_id`` is the smallest id reachable, ``kept`` says whether it is the row's own. A null
    id never becomes the smallest unless the group has no other. Null, empty and wordless texts
    have an empty set and link with nothing: their component is their own id. Repeated rows are linked like any copies. Of a very
    long text the shingles are gathered part by part; its whole set is compared.
    """
    with scratch(docs.sparkSession):
        return stage(_grouped(docs, words, percent).drop("_t"), "groups", keep=True)


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, limit: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` without the rows that :func:`near_duplicates` does not keep, all columns as they were.

    Columns may have any names. Of rows with the same id and text one stays. Rows without an id whose group has no id at all stay.
    """
    own = [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))), F.xxhash64("text")]
    with scratch(docs.sparkSession):
        grouped = _grouped(docs, words, percent).withColumn("__d", F.coalesce("doc_id", F.lit(-(2**63))))
        state = grouped.withColumnRenamed("_t", "__t").groupBy("__d", "__t").agg(F.max("kept").alias("__kept"), F.count("*").alias("__n"))
        state = stage(state.where(~F.col("__kept") | ((F.col("__n") > 1) & (F.col("__d") > -(2**63)))), "state", keep=True)
    few = state.count() <= limit
    rows = docs.select(own[0].alias("__d"), own[1].alias("__t"), F.struct("*").alias("row"))  # whatever the columns are called
    rows = rows.join(F.broadcast(state) if few else state.hint("shuffle_merge"), ["__d", "__t"], "left")
    single = rows.where("__n is null")
    several = rows.where("__kept").dropDuplicates(["__d", "__t"])
    return single.union(several).select("row.*")


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    kernels.small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_t"))
    kinds = "doc_id bigint, _t bigint, node binary, n_shingles bigint, bands array<bigint>, packed binary"
    sketches = stage(texts.mapInArrow(_sketch(words), kinds), "sketches")
    filled = sketches.where("n_shingles > 0")

    keys = filled.select("node", F.explode("bands").alias("key"))
    brief = F.xxhash64("node")
    shared = keys.groupBy("key").agg(F.min(brief).alias("low"), F.max(brief).alias("high"))
    shared = shared.where("low <> high").select("key")
    members = stage(keys.join(shared, "key").distinct(), "buckets")

    ids = members.select("node").distinct()
    nodes = filled.join(ids, "node").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("packed").alias("packed")
    )
    nodes = stage(nodes, "nodes")
    wanted = nodes.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), "node")
    chosen = join_ids(texts.withColumn("_id", F.coalesce("doc_id", F.lit(-(2**63)))), wanted, ["_id"])
    sets = chosen.select("node", "text").mapInArrow(_sets(words), "node binary, shingles binary")
    sets = sets.dropDuplicates(["node"]).join(nodes.select("node", "packed"), "node")
    sets = stage(sets.select("node", "shingles", "packed"), "sets")

    sizes = members.groupBy("key").agg(F.count("*").alias("size"))
    central = members.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("weight"))
    ranked = members.join(central, "node")
    leaders = ranked.groupBy("key").agg(
        F.max(F.struct("weight", "node")).alias("hub"),
        F.min(F.struct(F.xxhash64("node", F.lit(1)).alias("h"), "node")).alias("any"),
    )
    leaders = leaders.select("key", F.explode(F.array_distinct(F.array("hub.node", "any.node"))).alias("a"))
    pairs = leaders.join(members.withColumnRenamed("node", "b"), "key").where("a <> b").select("a", "b").distinct()
    links = stage(confirmed(pairs, sets, percent), "confirmed")

    found = components(links)
    roots = stage(
        ids.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots"
    )
    final = components(links.union(_cross_links(members, nodes, sets, roots, percent)))

    names = sketches.join(final, "node", "left").withColumn("group", F.coalesce("root", "node"))
    least = names.where("n_shingles > 0").groupBy("group").agg(F.min("doc_id").alias("least"))
    rows = names.join(least, "group", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "_t", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
