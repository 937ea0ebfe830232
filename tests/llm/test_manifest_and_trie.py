"""Manifest and prefix trie against plain Python, and on awkward rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests import oracle
from tidemill.llm import manifest, trie
from tidemill.llm.queries import ORACLES, QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree(leaves):
    """Root of a list of digests, and every leaf's neighbours with their sides."""
    paths, level, row = [[] for _ in leaves], 0, list(leaves)
    while len(row) > 1:
        for i, path in enumerate(paths):
            other = (i >> level) ^ 1
            path.append("" if other >= len(row) else ("<" if other < i >> level else ">") + row[other])
        row = [sha("".join(row[i : i + 2])) for i in range(0, len(row), 2)]
        level += 1
    return row[0], paths


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append(row)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in groups[lang]])
    root, above = tree([trees[lang][0] for lang in order])
    out = []
    for lang, over in zip(order, above):
        subroot, paths = trees[lang]
        for row, path in zip(groups[lang], paths):
            path = path + over
            now = dict(row)
            if row["doc_id"] is not None and row["n_chars"] is not None:
                now["n_chars"] += zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            folded = manifest.fold(leaf(now), path)
            proof = sha("".join(step[1:] for step in path))
            out.append((row["doc_id"], leaf(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def proved(docs, **options):
    found = manifest.proofs(docs, {"n_chars": manifest.tampered_n_chars()}, **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, f"t{i}", ["en", None, "", "de"][min(i % 9, 3)], f"s{i % 3}", i) for i in range(80)]
    rows += [(None, None, None, None, None), (None, "ß", "en", None, 3), (7, "t7", "de", "s1", 7), (7, "t7", "de", "s1", 7)]
    rows += [(200, "alone", "fr", "s", 5), (-14, "", "en", "", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    plain = [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in rows]
    return plain, frame.withColumns({c: F.lit("mine") for c in ("tree", "at", "digest", "now", "root", "leaf")})


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_proofs(documents, levels):
    plain, frame = documents
    assert proved(frame, levels=levels) == expected(plain)


def test_one_language_and_one_row(spark, documents):
    plain, frame = documents
    assert proved(frame.where("lang = 'fr'")) == expected([r for r in plain if r["lang"] == "fr"])
    assert proved(frame.where("lang = 'de'"), levels=3) == expected([r for r in plain if r["lang"] == "de"])


def test_manifest_of_nothing(documents):
    assert proved(documents[1].limit(0)) == []


def test_manifest_query_and_sql(spark, small):
    query = QUERIES["op12_manifest"](spark, small)
    assert oracle.compare(query, oracle.connect(small), ORACLES["op12_manifest"]) is None


@pytest.mark.parametrize("levels", range(9))
def test_layout_is_a_permutation_split_at_half_height(levels):
    places = manifest.addresses(levels)
    assert sorted(places.tolist()) == list(range(2 ** (levels + 1) - 1))
    upper = (levels + 1) // 2
    if upper:
        assert places[: 2**upper - 1].max() == 2**upper - 2  # the upper half is stored first
        leaves = places[2**levels - 1 :].reshape(2**upper, -1)
        size = 2 ** (levels + 1 - upper) - 1
        assert ((leaves.max(axis=1) - leaves.min(axis=1)) < size).all()  # a lower subtree lies together


@pytest.mark.parametrize("leaves, levels", [(1, 0), (1, 3), (5, 3), (8, 3), (200, 8)])
def test_block_round_trip(leaves, levels):
    digests = [sha(str(i)) for i in range(leaves)]
    block = manifest.Block.build(digests, levels)
    again = manifest.Block.from_bytes(leaves, levels, block.to_bytes())
    for digest, path in zip(digests, again.siblings()):
        assert manifest.fold(digest, path) == block.root == again.root


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)

    def below(path):
        own = [len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) * (len(members[path]) - 1) if path else 0, not children[path]]
        for child in children[path]:
            for i, x in enumerate(below(child)):
                own[i] += x
        return own

    out = []
    for path, convs in members.items():
        saved, leaves = below(path)
        ends = ",".join(str(c) for c in sorted(convs) if paths[c] == path)
        up = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), up, len(convs), len(children[path]), int(leaves), saved, sha(ends)))
    return sorted(out, key=repr)


def in_spark(frame, **options):
    return sorted((tuple(r) for r in trie.prefix_trie(frame, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def conversations(spark):
    rows = []
    for c in range(150):
        for t in range(c % 5 if c % 20 else 3):
            text = "same words here" if c % 3 == 0 else f"{'x ' * (c % 4)}{c % (t + 2)}"
            rows.append((c, t, ["user", "assistant", None][t % 3], text if c % 7 else None))
    rows += [(400 + i, t, "user", "copied turn") for i in range(60) for t in range(3)]
    rows += [(700, None, "user", "first"), (700, 0, "user", "second"), (None, 0, "user", "nobody's"), (900, 0, None, None)]
    rows += [(1_000, t, "user", f"long {t}") for t in range(90)] + [(1_001, t, "user", f"long {t}") for t in range(80)]
    return rows, spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


@pytest.mark.parametrize("shards", [1, 2, 7, 60])
def test_trie(conversations, shards):
    rows, frame = conversations
    assert in_spark(frame.withColumns({c: F.lit(1) for c in ("path", "words", "shard", "base")}), shards=shards) == plain_trie(rows)


def test_hot_conversation_is_dealt_over_shards(spark, conversations):
    convs = trie.rebuilt(conversations[1])
    cuts = trie.splitters(convs, 40)
    assert any(own > -(2**63) for _, own in cuts)  # the copies are split by id
    assert cuts == sorted(cuts) and len(cuts) < 40


def test_runs_of_ids(conversations, monkeypatch):
    rows, frame = conversations
    monkeypatch.setattr(trie, "IDS_PER_RUN", 2)
    skeleton = trie.Skeleton([(b"", 5), (b"a" * 16, 10)])
    shard = trie._Shard(0, skeleton)
    for i in range(5):
        shard.add(b"", i, [])
    shard.end()
    assert [r[-2:] for r in shard.rows if r[-1]] == [(0, "0,1"), (1, "2,3"), (2, "4")]


def test_trie_of_nothing(conversations):
    assert in_spark(conversations[1].limit(0)) == []


def test_trie_query_and_sql(spark, small):
    query = QUERIES["op13_trie"](spark, small)
    assert oracle.compare(query, oracle.connect(small), ORACLES["op13_trie"]) is None
