"""Near-duplicate vectors by a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.graph import components
from tidemill.session import stage

TREES, LEAF, SPILL, SEED = 6, 400, 0.08, 3
MAX_NODES = 60_000  # split nodes that the driver holds and sends; leaves that stay large are cut into blocks
BLOCK = 1_000
SAMPLE = 200_000  # vectors that the splits are fitted on, at most


@dataclass
class Forest:
    """Split nodes by ``(group, tree, path)``; each has a direction by its own seed and two thresholds.

    A vector whose projection lies between the thresholds goes to both sides.
    """

    splits: dict[tuple[int, int, int], tuple[float, float]] = field(default_factory=dict)

    @staticmethod
    def direction(tree: int, path: int, size: int) -> np.ndarray:
        return np.random.default_rng([SEED, tree, path, size]).standard_normal(size)

    def leaves(self, group: int, tree: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaf paths of all vectors of a group; a vector may reach several leaves."""
        rows, paths = [], []
        waiting = [(1, np.arange(len(vectors)))]
        while waiting:
            path, at = waiting.pop()
            cut = self.splits.get((group, tree, path))
            if cut is None or not len(at):
                rows.append(at)
                paths.append(np.full(len(at), path, np.int64))
                continue
            value = vectors[at] @ self.direction(tree, path, vectors.shape[1])
            waiting.append((2 * path, at[value <= cut[1]]))
            waiting.append((2 * path + 1, at[value >= cut[0]]))
        return np.concatenate(rows), np.concatenate(paths)


def grow(groups: dict[int, tuple[np.ndarray, float]], trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> Forest:
    """Split every group's sample at random medians until each leaf stands for ``leaf`` vectors or fewer.

    ``groups`` maps a group to its sampled vectors and to how many vectors each of them stands for. Nodes are split
    level by level, so a full table of :data:`MAX_NODES` splits leaves all trees equally deep.
    """
    forest = Forest()
    level = [(g, t, 1, np.arange(len(v)), 0) for g, (v, _) in groups.items() for t in range(trees)]
    while level:
        below = []
        for group, tree, path, at, depth in level:
            vectors, stands_for = groups[group]
            if len(at) * stands_for <= leaf or len(at) < 8 or depth >= 40 or len(forest.splits) >= MAX_NODES:
                continue
            value = vectors[at] @ forest.direction(tree, path, vectors.shape[1])
            low, high = np.quantile(value, [0.5 - spill, 0.5 + spill])
            left, right = at[value <= high], at[value >= low]
            if len(left) == len(at) or len(right) == len(at):
                continue  # mostly equal projections: not to be split
            forest.splits[group, tree, path] = (float(low), float(high))
            below += [(group, tree, 2 * path, left, depth + 1), (group, tree, 2 * path + 1, right, depth + 1)]
        level = below
    return forest


def _unit(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _routed(forest, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            groups = batch.column("grp").to_numpy()
            for size in np.unique(sizes):
                chosen = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(chosen))
                vectors = _unit(part.column("unit"))
                own = groups[chosen]
                home: list[list[int]] = [[] for _ in chosen]
                rows, tree_of, path_of = [], [], []
                for group in np.unique(own):
                    at = np.flatnonzero(own == group)
                    for tree in range(trees):
                        row, path = forest.value.leaves(int(group), tree, vectors[at])
                        rows.append(at[row])
                        tree_of.append(np.full(len(row), tree, np.int32))
                        path_of.append(path)
                        for r, p in zip(at[row].tolist(), path.tolist()):
                            home[r].append(p << 8 | tree)
                rows = np.concatenate(rows)
                out = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [out.column("node"), out.column("copies"), out.column("grp"), pa.array(np.concatenate(tree_of)),
                     pa.array(np.concatenate(path_of)), out.column("unit"),
                     pa.array([home[r] for r in rows.tolist()], pa.list_(pa.int64()))],
                    ["node", "copies", "grp", "tree", "path", "unit", "home"],
                )

    return run


def _compared(least: float):
    """Links of one leaf (or of two blocks of it), gathered by node: ``node, root, others``.

    ``root`` is the least node that the links found here lead to, ``others`` the copies of all nodes linked
    directly, so a group of near copies gives a row for each of its nodes, not for each pair. A pair counts in
    the first leaf that the two share.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left = rows[rows["side"] == 0].reset_index(drop=True)
        right = rows[rows["side"] == 1].reset_index(drop=True)
        others: dict[int, int] = {}
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            while parent.setdefault(node, node) != node:
                parent[node] = parent[parent[node]]
                node = parent[node]
            return node

        if len(left) and len(right):
            here = int(rows["path"].iloc[0]) << 8 | int(rows["tree"].iloc[0])
            one, two = np.stack(left["unit"].to_numpy()), np.stack(right["unit"].to_numpy())
            lefts, rights = left["node"].tolist(), right["node"].tolist()
            weigh, weighs = left["copies"].tolist(), right["copies"].tolist()
            homes = [set(x) for x in right["home"]]
            whole = bool(rows["same"].iloc[0])
            for at in range(0, len(one), 256):
                a, b = np.nonzero(one[at : at + 256] @ two.T >= least)
                for i, j in zip((a + at).tolist(), b.tolist()):
                    x, y = lefts[i], rights[j]
                    if whole and x >= y:
                        continue
                    shared = [h for h in left["home"].iat[i] if h in homes[j]]
                    if min(shared, key=lambda h: (h & 255, h)) == here:
                        others[x] = others.get(x, 0) + weighs[j]
                        others[y] = others.get(y, 0) + weigh[i]
                        low, high = sorted((root(x), root(y)))
                        parent[high] = low
        found = [(node, root(node), count) for node, count in others.items()]
        return pd.DataFrame(found, columns=["node", "root", "others"], dtype="int64")

    return run


def _blocks(rows: DataFrame) -> DataFrame:
    """Every leaf once, or, if it is larger than :data:`BLOCK`, once for each pair of its blocks."""
    sizes = rows.groupBy("grp", "tree", "path").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    rows = rows.join(sizes, ["grp", "tree", "path"])
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    rows = rows.withColumn("part", part)
    rows = rows.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    i, j = F.least("p", "part"), F.greatest("p", "part")
    side = F.when(i == j, F.array(F.lit(0), F.lit(1))).otherwise(F.array((F.col("part") != i).cast("int")))
    return rows.select("grp", "tree", "path", "node", "copies", "unit", "home", i.alias("i"), j.alias("j"), (i == j).alias("same"), F.explode(side).alias("side"))


def near_vectors(
    vectors: DataFrame, least: float = 0.98, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL
) -> DataFrame:
    """Links between vectors of one label by cosine: ``vec_id, n_links, component_id, kept``.

    Equal vectors of a label are one node. The trees of a label are fitted on a sample (all of it up to
    :data:`SAMPLE` vectors of all labels together, a fixed choice by hash), every node is sent down all trees,
    both ways where it lies within ``spill`` of a median, and compared with the others of its leaves; cosines
    are in double precision. Leaves that stay large are compared block by block, all pairs.

    ``n_links`` counts the other vectors linked directly, copies too; ``component_id`` is the smallest id reachable,
    ``kept`` says whether it is the row's own. A null label or vector, a zero vector and one with null or
    non-finite components link with nothing; vectors of other lengths never link. Repeated rows are copies. A null id is
    never the smallest unless the group has no other.
    """
    e = F.col("embedding").cast("array<double>")
    sound = (
        F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
        & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(e, lambda x: x != 0)
    )
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), e.alias("v"), F.coalesce(sound, F.lit(False)).alias("sound"))
    plain = F.transform("v", lambda x: x + F.lit(0.0))  # one zero only
    top = F.array_max(F.transform("v", F.abs))
    scaled = F.transform("v", lambda x: x / F.col("top"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0).cast("double"), lambda s, x: s + x * x))
    rows = rows.withColumn("v", F.when(F.col("sound"), plain)).withColumn("top", top).withColumn("v", scaled)
    rows = rows.withColumn("unit", F.transform("v", lambda x: x / norm))
    names = [F.xxhash64("label", "v", "top"), F.xxhash64(F.lit(1), "top", "v", "label")]
    rows = rows.select(
        "vec_id", "sound", "label", "unit", F.when(F.col("sound"), F.struct(names[0].alias("x"), names[1].alias("y"))).alias("name")
    )
    rows = stage(rows, "vectors")
    copies = rows.where("sound").groupBy("name").agg(
        F.first("label").alias("label"), F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min("vec_id").alias("least")
    )
    copies = copies.withColumn("node", F.monotonically_increasing_id()).withColumn("size", F.size("unit"))
    copies = copies.withColumn("grp", F.xxhash64("label", "size"))
    copies = stage(copies.drop("label"), "nodes")

    counts = copies.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > leaf)
    counts = {r["grp"]: r["n"] for r in counts.orderBy(F.desc("n"), "grp").limit(MAX_NODES // trees).collect()}
    share = min(1.0, SAMPLE / max(1, copies.count()))
    sample = copies.where(F.pmod(F.xxhash64("node"), F.lit(2**20)) < int(share * 2**20))
    table = sample.where(F.col("grp").isin(list(counts))).select("grp", "unit").limit(2 * SAMPLE).toArrow() if counts else None
    groups = {}
    if table is not None and table.num_rows:
        own, units = table.column("grp").to_numpy(), table.column("unit").combine_chunks()
        for group in np.unique(own).tolist():
            part = _unit(units.take(pa.array(np.flatnonzero(own == group))))
            groups[group] = (part, counts[group] / len(part))
    forest = copies.sparkSession.sparkContext.broadcast(grow(groups, trees, leaf, spill))

    kinds = "node bigint, copies bigint, grp bigint, tree int, path bigint, unit array<double>, home array<bigint>"
    placed = copies.select("node", "copies", "grp", "size", "unit").repartition("node").mapInArrow(_routed(forest, trees), kinds)
    links = _blocks(stage(placed, "leaves")).groupBy("grp", "tree", "path", "i", "j").applyInPandas(
        _compared(least), "node bigint, root bigint, others bigint"
    )
    links = stage(links, "links")
    others = links.groupBy("node").agg(F.sum("others").alias("others"))
    found = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = copies.select("name", "node", "copies", "least").join(others, "node", "left").join(found, "node", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "node"))
    least_of = nodes.groupBy("root").agg(F.min("least").alias("component"))
    nodes = nodes.join(least_of, "root").select(
        F.col("name").alias("n"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component"
    )
    done = rows.select("vec_id", "name").join(nodes, F.col("name") == F.col("n"), "left")
    component = F.when(F.col("n").isNotNull(), F.col("component")).otherwise(F.col("vec_id"))
    return done.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
