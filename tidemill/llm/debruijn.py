"""Repeated word spans by a compacted de Bruijn graph."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import kernels
from tidemill.llm.graph import join_ids
from tidemill.session import scratch, stage

WINDOW = 35  # words of an edge of the graph
ANCHOR = 16  # words of the anchors that stretches of edges are gathered by
# Most rows, entries of rows, and anchors that are broadcast; beyond, both sides of a join are shuffled.
BROADCAST_ROWS, BROADCAST_ENTRIES, BROADCAST_ANCHORS = 200_000, 3_000_000, 2_000_000
_AT_BITS = 24
_DOC = ["__d", "__t"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that only rows with equal id and text share; such rows have equal results."""
    own = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    return docs.withColumn("__d", own).withColumn("__t", F.xxhash64("text"))


class _Edges:
    """All edges (windows of ``size`` words) of a block of texts, cut into stretches.

    A stretch is a maximal run of edges of one text with the same anchor: the same place of the least
    hash of ``ANCHOR`` words in each. An edge's anchor depends on its words alone, so equal edges lie in
    stretches with equal anchors wherever they stand.
    """

    def __init__(self, words: kernels.Words, size: int):
        self.words, own = words, words.hashes()
        anchor = min(ANCHOR, size)
        parts = kernels.windows(own, anchor)
        place = np.arange(len(parts), dtype=np.uint64)
        low = np.uint64((1 << _AT_BITS) - 1)
        count = max(0, len(own) - size + 1)
        self.sums = kernels.prefix(own, kernels.WORD_BASE)
        self.size = size
        if not count:
            self.doc = self.start = self.edges = np.zeros(0, np.int64)
            self.anchor = self.content = np.zeros(0, np.uint64)
            return
        least = kernels.sliding_min((parts & ~low) | (place & low), size - anchor + 1)[:count]
        doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))[:count]
        inside = np.arange(count) + size <= words.first[doc + 1]
        new = np.ones(count, bool)
        new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new & inside)
        # a stretch ends where the next begins or its text has no further edge
        stop = np.flatnonzero(np.concatenate((new[1:] | ~inside[1:], [True])) & inside) + 1
        self.doc, at = doc[first], first
        self.start, self.edges = at - words.first[self.doc], stop - first
        # the low bits of an anchor are its place in the block, modulo their number
        back = (least[first] & low).astype(np.int64)
        full = at + ((back - at) & int(low))
        self.anchor = parts[full]
        spans = kernels.span_hash(self.sums, at, stop + size - 1, kernels.WORD_BASE)
        self.content = kernels.mix(spans + self.edges.astype(np.uint64), 21)

    def hashes(self, doc: int, start: int, edges: int) -> np.ndarray:
        at = self.words.first[doc] + start + np.arange(edges)
        return kernels.mix(kernels.span_hash(self.sums, at, at + self.size, kernels.WORD_BASE), 22)


def _parts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[_Edges, int]]:
    """Edges of a block, with the number of the first word; of a long text part by part, each edge in one part."""
    for words, first in kernels.slices(batch.column("text"), size - 1):
        yield _Edges(words, size), first


def _anchors(size: int):
    """Anchors of all stretches, with how often they stand in a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            for found, _ in _parts(batch, size):
                anchors, n = np.unique(found.anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(n, pa.int64())], ["anchor", "n"])

    return run


def _stretches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            for found, first in _parts(batch, size):
                keys = [batch.column(c).take(pa.array(found.doc, pa.int64())) for c in _DOC]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.anchor.view(np.int64)), pa.array(found.content.view(np.int64)), *keys,
                     pa.array(first + found.start, pa.int64()), pa.array(found.edges.astype(np.int16))],
                    ["anchor", "content", *_DOC, "start", "edges"],
                )

    return run


def _edge_hashes(size: int):
    """The single edges of chosen stretches, from the text they stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            out = {c: [] for c in ("anchor", "content", "weight", "at", "edge")}
            wanted = batch.column("chosen").to_pylist()
            for found, first in _parts(batch, size):
                after = first + len(found.words.start) - size + 1  # of the part's edges; a block has one part
                for doc, chosen in enumerate(wanted):
                    for x in chosen:
                        if batch.num_rows == 1 and not first <= x["start"] < after:
                            continue
                        edges = found.hashes(doc, x["start"] - first, x["edges"])
                        out["edge"].append(edges.view(np.int64))
                        out["at"].append(np.arange(len(edges), dtype=np.int16))
                        for c in ("anchor", "content", "weight"):
                            out[c].append(np.full(len(edges), x[c], np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v) if v else np.zeros(0, np.int64)).cast(pa.int16() if c == "at" else pa.int64())
                 for c, v in out.items()], list(out),
            )

    return run


def join_by_document(docs: DataFrame, info: DataFrame, how: str, limit: int) -> DataFrame:
    """Add stored per-document ``info`` to the texts.

    Info of at most ``limit`` documents with :data:`BROADCAST_ENTRIES` entries in all is broadcast, so that texts stay where they are read; beyond
    that, both sides are shuffled by document.
    """
    entries = F.sum(F.size(next(c for c in info.columns if c not in _DOC)))
    rows, entries = info.agg(F.count("*"), F.coalesce(entries, F.lit(0))).first()
    few = rows <= limit and entries <= BROADCAST_ENTRIES
    return docs.join(F.broadcast(info) if few else info.hint("shuffle_merge"), _DOC, how)


def repeated_paths(
    docs: DataFrame, size: int = WINDOW, limit: int = BROADCAST_ROWS, anchors: int = BROADCAST_ANCHORS
) -> DataFrame:
    """Repeated spans ``__d, __t, start, words, path`` of keyed documents, compacted to paths.

    1. Every text is cut into stretches of edges that share an anchor. Stretches whose anchor stands once
       in the corpus hold no repeated edge: a first pass over the texts counts anchors only, a second one keeps
       the stretches of those that repeat, where the texts are read while the repeated anchors can be broadcast.
    2. Equal stretches are counted once with their number. Where an anchor has one stretch only, all its
       edges are repeated as often; where it has several, their edges are counted singly and the
       stretch is cut where the count changes, which is where paths branch.
    3. In the graph of the pieces two neighbours belong to one path if each is the other's only
       neighbour on that side in all the corpus. The pieces of a text are joined to those marks and
       chained by their coordinates.

    ``path`` is the content key of a path's first piece; equal whole paths have equal keys and lengths. All keys are hashes of
    64 bits looked up under an anchor's own 64 bits.
    """
    kinds = "anchor bigint, content bigint, __d bigint, __t bigint, start bigint, edges smallint"
    texts = docs.select(*_DOC, "text")
    counted = texts.select("text").mapInArrow(_anchors(size), "anchor bigint, n bigint")
    often = stage(counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "often")
    rows = stage(join_ids(texts.mapInArrow(_stretches(size), kinds), often, ["anchor"], anchors), "repeated")

    kinds_of = rows.groupBy("anchor", "content").agg(
        F.count("*").alias("weight"), F.min(F.struct(*_DOC, "start", "edges")).alias("where")
    )
    kinds_of = stage(kinds_of, "kinds")
    mixed = stage(kinds_of.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "mixed")
    chosen = join_ids(kinds_of, mixed, ["anchor"], anchors).select(
        *[F.col(f"where.{c}").alias(c) for c in _DOC],
        F.struct("anchor", "content", "weight", "where.start", "where.edges").alias("x"),
    )
    chosen = stage(chosen.groupBy(*_DOC).agg(F.collect_list("x").alias("chosen")), "chosen")
    once = "anchor bigint, content bigint, weight bigint, at smallint, edge bigint"
    # rows with the same id and text would give the same edges again
    held = join_by_document(texts, chosen, "inner", limit).select("chosen", "text")
    singles = held.mapInArrow(_edge_hashes(size), once)
    singles = stage(singles.groupBy("anchor", "edge", "content", "at").agg(F.max("weight").alias("weight")), "edges")
    counted = singles.groupBy("anchor", "edge").agg(F.sum("weight").alias("total")).where("total > 1")
    kept = singles.join(counted, ["anchor", "edge"]).groupBy("anchor", "content").agg(
        F.sort_array(F.collect_list(F.struct("at", "total", "edge"))).alias("kept")
    )

    pieces = kinds_of.join(mixed.withColumn("is_mixed", F.lit(True)), "anchor", "left")
    pieces = pieces.join(kept, ["anchor", "content"], "left")
    whole = F.array(
        F.struct(F.lit(0).alias("from"), F.col("where.edges").cast("int").alias("edges"), F.col("content").alias("piece"))
    )
    grown = F.aggregate(
        F.coalesce("kept", F.array().cast("array<struct<at:smallint,total:bigint,edge:bigint>>")),
        F.array().cast("array<struct<from:int,edges:int,total:bigint,first:bigint,last:bigint>>"),
        _grow,
    )
    cut = F.transform(
        grown,
        lambda x: F.struct(x["from"].alias("from"), x["edges"].alias("edges"), F.xxhash64(x["first"], x["last"], x["edges"]).alias("piece")),
    )
    all_repeated = F.when(F.col("weight") > 1, whole).otherwise(F.array().cast("array<struct<from:int,edges:int,piece:bigint>>"))
    pieces = pieces.select(
        "anchor", "content", F.when(F.col("is_mixed"), cut).otherwise(all_repeated).alias("pieces")
    ).where(F.size("pieces") > 0)
    placed = rows.join(pieces, ["anchor", "content"]).withColumn("p", F.explode("pieces")).select(
        *_DOC, (F.col("start") + F.col("p.from")).alias("start"), F.col("p.edges").alias("edges"), F.col("p.piece").alias("piece")
    ).distinct()
    return _compact(stage(placed, "pieces"), size)


def _grow(found: Column, x: Column) -> Column:
    """Lengthen the last piece by the next edge, or begin a piece where the count or the run breaks."""
    last = F.element_at(found, -1)
    at = x["at"].cast("int")
    goes_on = (F.size(found) > 0) & (last["total"] == x["total"]) & (last["from"] + last["edges"] == at)

    def piece(start, edges, first):
        return F.struct(
            start.alias("from"), edges.alias("edges"), x["total"].alias("total"), first.alias("first"), x["edge"].alias("last")
        )

    longer = F.concat(
        F.slice(found, F.lit(1), F.size(found) - 1), F.array(piece(last["from"], last["edges"] + 1, last["first"]))
    )
    return F.when(goes_on, longer).otherwise(F.concat(found, F.array(piece(at, F.lit(1), x["edge"]))))


def _compact(pieces: DataFrame, size: int) -> DataFrame:
    """Chain neighbouring pieces of a text over joints that do not branch."""
    order = Window.partitionBy(*_DOC).orderBy("start")
    follows = F.lead("start").over(order) == F.col("start") + F.col("edges")
    rows = pieces.withColumn("next", F.when(follows, F.lead("piece").over(order)))
    joints = rows.groupBy("piece", "next").agg(F.count("*").alias("n"))
    out = joints.groupBy("piece").agg(F.count("*").alias("ways_out"), F.max("next").alias("next")).where("ways_out = 1 and next is not null")
    before = rows.withColumn("behind", F.lag("next").over(order) == F.col("piece"))
    starts = before.where(~F.coalesce("behind", F.lit(False))).select("piece").distinct()
    into = joints.where("next is not null").groupBy("next").agg(F.count("*").alias("ways_in")).where("ways_in = 1")
    into = into.join(starts, F.col("next") == F.col("piece"), "left_anti")
    plain = out.join(into, "next").select("piece", "next", F.lit(True).alias("plain"))
    marked = rows.join(plain, ["piece", "next"], "left")
    opens = ~F.coalesce(F.lag("plain").over(order), F.lit(False))
    chained = marked.withColumn("chain", F.sum(opens.cast("int")).over(order))
    return chained.groupBy(*_DOC, "chain").agg(
        F.min("start").alias("start"),
        (F.sum("edges") + size - 1).alias("words"),
        F.min_by("piece", "start").alias("path"),
    ).drop("chain")


def _kept_text(rows_out):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            spans = batch.column("__spans").to_pylist()
            kept: list[list[bytes]] = [[] for _ in spans]
            total, removed = np.zeros(len(spans), np.int64), np.zeros(len(spans), np.int64)
            for words, before in kernels.slices(batch.column("text"), 0):
                data = words.data.tobytes()
                for doc, own in enumerate(spans):
                    first, count = words.first[doc], words.first[doc + 1] - words.first[doc]
                    gone = np.zeros(count, bool)
                    for x in own or ():
                        gone[max(0, x["start"] - before) : max(0, x["start"] + x["words"] - before)] = True
                    at = first + np.flatnonzero(~gone)
                    if len(at):
                        kept[doc].append(b" ".join([data[s:e] for s, e in zip(words.start[at].tolist(), words.end[at].tolist())]))
                    total[doc] += count
                    removed[doc] += gone.sum()
            yield rows_out(batch, [b" ".join(own) for own in kept], total.tolist(), removed.tolist())

    return run


def _digest(batch, kept, total, removed):
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").cast(pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
         pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
        ["doc_id", "n_words", "n_removed", "kept_sha256"],
    )


def _texts(columns: list[str]):
    """The rows again as they were but for their texts, from the texts and a struct of the other columns."""

    def out(batch, kept, total, removed):
        own = batch.column("text").to_pylist()
        texts = pa.array([k.decode() if gone else text for k, gone, text in zip(kept, removed, own)], batch.schema.field("text").type)
        others = iter(batch.column("row").flatten())
        return pa.RecordBatch.from_arrays([texts if c == "text" else next(others) for c in columns], columns)

    return out


def _merged(spans: Column) -> Column:
    """Sorted spans with those joined that overlap or touch."""

    def add(found: Column, x: Column) -> Column:
        last = F.element_at(found, -1)
        end = F.greatest(last["start"] + last["words"], x["start"] + x["words"])
        longer = F.struct(last["start"].alias("start"), (end - last["start"]).alias("words"))
        goes_on = (F.size(found) > 0) & (x["start"] <= last["start"] + last["words"])
        return F.when(goes_on, F.concat(F.slice(found, F.lit(1), F.size(found) - 1), F.array(longer))).otherwise(
            F.concat(found, F.array(x))
        )

    return F.aggregate(F.sort_array(spans), F.array().cast("array<struct<start:bigint,words:bigint>>"), add)


def _with_spans(rows: DataFrame, size: int, limit: int) -> DataFrame:
    """``doc_id, text`` and more, with the places of the repeated words. The tables made on the way are deleted."""
    kernels.small_batches(rows.sparkSession)
    keyed = _keyed(rows)
    with scratch(rows.sparkSession):
        paths = repeated_paths(keyed, size, limit)
        span = F.struct(F.col("start").cast("bigint").alias("start"), F.col("words").cast("bigint").alias("words"))
        spans = stage(paths.groupBy(*_DOC).agg(_merged(F.collect_list(span)).alias("__spans")), "spans", keep=True)
    return join_by_document(keyed, spans, "left", limit)


def without_repeats(docs: DataFrame, size: int = WINDOW, limit: int = BROADCAST_ROWS) -> DataFrame:
    """What is left of each text when the spans that stand more than once in the corpus are taken out.

    A word goes if it lies in a window of ``size`` consecutive words of its text whose sequence also starts
    anywhere else, in any text or the same. Windows are judged on the input, so all copies lose
    the span, the first one too. Returns ``doc_id, n_words, n_removed, kept_sha256``, the hash of the kept
    words joined by one space.

    Null, empty and short texts have no window and keep all words; an empty table gives an empty result.
    Repeated rows count as separate texts, so both lose all that fills a window. A null id stays null. A very long text is
    worked through in parts that share ``size - 1`` words; no text is cut for the result.
    """
    rows = _with_spans(docs.select("doc_id", "text"), size, limit).select("doc_id", "text", "__spans")
    return rows.mapInArrow(
        _kept_text(_digest), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    )


def cleaned(docs: DataFrame, size: int = WINDOW, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with the repeated spans taken out of ``text``; the other columns, of whatever name, as they were.

    A text that loses words is its kept words joined by one space; all others are unchanged. Null ids, null, empty and very long
    texts, repeated rows and empty tables are taken as by :func:`without_repeats`.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = _with_spans(docs.select("doc_id", "text", others.alias("row")), size, limit)
    return rows.select("text", "row", "__spans").mapInArrow(_kept_text(_texts(docs.columns)), docs.schema)
