"""The operators on documents: against plain Python, and on awkward rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import bpe, crossent, debruijn, digest, kernels, minhash, mixing, ordinal, packing, rollup
from tidemill.session import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, count):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * seed) % 997}" for i in range(count))


@pytest.fixture(scope="module")
def awkward(spark):
    base = prose(1, 120)
    texts = [None, "", " \n\t", "one", "One two", base, base, base.replace("w1", "x1", 2), base + " tail", prose(2, 9000)]
    texts += [prose(3, 60) + " " + base[:400], "ß é 日本   x", "a  b\n\nc", prose(4, 50), "same " * 300]
    rows = [(i, t, "en", f"s{i % 3}" if i else None, 7) for i, t in enumerate(texts)]
    rows += [(5, base, "en", "s2", None), (None, base, None, None, 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def clashing(awkward):
    names = ["size", "node", "spans", "part", "selected", "target", "kept", "tokens", "_d", "_t", "start", "grade"]
    return awkward.select("*", *[F.lit("mine").alias(n) for n in names])


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.limit(0)


def sets_of(rows, size):
    out = []
    for _, text in rows:
        words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
        runs = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        out.append(frozenset(runs or ([tuple(words)] if words else [])))
    return out


def groups_of(rows, size):
    sets, parent = sets_of(rows, size), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    found = []
    for i, own in enumerate(sets):
        ids = [rows[j][0] for j in range(len(rows)) if own and root(j) == root(i) and rows[j][0] is not None]
        component = rows[i][0] if not own else min(ids, default=None)
        found.append((rows[i][0], len(own), component, rows[i][0] == component))
    return Counter(found)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(awkward, clashing, size):
    expected = groups_of(pairs(awkward), size)
    assert Counter(map(tuple, minhash.near_duplicates(awkward, size).collect())) == expected
    assert Counter(map(tuple, minhash.near_duplicates(clashing, size).collect())) == expected


def test_near_duplicates_with_many_links_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 8)
    monkeypatch.setattr(minhash, "PAIRS_PER_LEADER", 5)
    base = [f"v{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in range(i % 13):
            words[(i * 17 + k * 11) % 150] = f"z{i}_{k}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, minhash.near_duplicates(docs, 2).collect())) == groups_of(rows, 2)


def test_one_of_each(awkward, clashing):
    kept = minhash.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[5] == 1 and ids[6] == 0 and ids[8] == 0 and ids[0] == 1 and ids[13] == 1
    assert Counter(r.doc_id for r in minhash.one_of_each(awkward, limit=0).collect()) == ids


def without(rows, size):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_repeated_spans(awkward, clashing, limit):
    expected = without(pairs(awkward), 35)
    assert sum(n * k for (_, _, n, _), k in expected.items()) > 500
    assert Counter(map(tuple, debruijn.without_repeats(clashing, limit=limit).collect())) == expected


def test_paths_are_whole_passages(spark):
    """A passage between different neighbours is one path, the same in both texts."""
    shared = prose(9, 80)
    rows = [(i, f"{prose(20 + i, 40)} {shared} {prose(40 + i, 40)}") for i in range(3)]
    docs = debruijn._keyed(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = debruijn.repeated_paths(docs).collect()
    assert [(r.start, r.words) for r in found] == [(40, 80)] * 3
    assert len({r.path for r in found}) == 1


def test_cleaned_texts_keep_their_columns(clashing):
    left = debruijn.cleaned(clashing)
    assert left.columns == clashing.columns
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id is not None}
    assert texts[12] == "a  b\n\nc" and texts[0] is None and texts[5] == ""


def test_token_ids(awkward):
    tokenizer = bpe._tokenizer(bpe.VOCABULARY)[0]
    column = awkward.select("text").toArrow().column("text")
    ids, bounds = bpe.encode(column)
    for i, text in enumerate(column.to_pylist()):
        own = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == own


def test_packing(awkward, clashing):
    tokenizer = bpe._tokenizer(bpe.VOCABULARY)[0]
    rows = packing.pack(clashing, with_ids=True).collect()
    full = {}
    for r in rows:
        assert 0 < r.length == len(r.ids) and r.offset + r.length <= 1024
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in full.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
    own = sorted((r.piece, r.start, r.ids) for r in rows if r.doc_id == 9)
    assert sum((ids for *_, ids in own), []) == tokenizer.encode(prose(9 - 7, 9000), add_special_tokens=False).ids + [2]
    assert all(len(ids) == 1024 for piece, _, ids in own if piece)
    assert sum(r.doc_id is None for r in rows) >= 2


def test_plan_is_as_good_as_largest_first():
    import bisect

    import numpy as np

    for seed, count in ((0, 40), (1, 300), (2, 5_000)):
        lengths = np.random.default_rng(seed).integers(1, 1024, count)
        plan = packing.rounded(np.bincount(lengths, minlength=1025))
        assert (sum(c * n for c, n in plan) == np.bincount(lengths, minlength=1025)).all()
        free, bins = [], 0  # best fit decreasing
        for length in sorted(lengths.tolist(), reverse=True):
            at = bisect.bisect_left(free, length)
            if at == len(free):
                bins += 1
                free.append(1024)
                at = len(free) - 1
            bisect.insort(free, free.pop(at) - length)
        assert sum(n for _, n in plan) <= bins + max(1, bins // 100)


def test_mixing(awkward, clashing):
    rows = mixing.mix(clashing).collect()
    assert len(rows) == awkward.count()
    total = sum(r["size"] for r in rows)
    targets = {r.source: (r.source_size, r.target) for r in rows}
    assert all(t <= 2 * s + 1e-6 for s, t in targets.values())
    assert sum(t for _, t in targets.values()) == pytest.approx(1.5 * total)
    order = sorted(targets, key=lambda s: (s is None, s))
    levels = {s: targets[s][1] / (3, 1, 2)[i % 3] for i, s in enumerate(order) if targets[s][1] < 2 * targets[s][0] - 1e-6}
    assert len({round(x, 6) for x in levels.values()}) <= 1
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    again = mixing.mix(awkward.repartition(3)).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in rows)


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 4}") for i in range(2_000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    for r in mixed.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert abs(r.t - r.n) <= 50


def test_fingerprints(awkward, clashing):
    rows = digest.fingerprint_documents(clashing).collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert by_id[5][0].fingerprint == by_id[6][0].fingerprint
    assert by_id[6][0].near_next == 1.0 and by_id[14][0].near_next < 0.3
    text, follow = "same " * 300, prose(4, 50)
    edited = text[: len(text) - len(text) // 2] + follow[: len(text) // 2]
    assert by_id[14][0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert by_id[0][0].n_chars == 0 and by_id[0][0].fingerprint.startswith("0:")


def test_fingerprints_over_ranges(awkward, monkeypatch):
    whole = Counter(map(tuple, digest.fingerprint_documents(awkward).collect()))
    monkeypatch.setattr(digest, "RANGE_ROWS", 4)
    assert Counter(map(tuple, digest.fingerprint_documents(awkward.repartition(5)).collect())) == whole


def test_ordinal_model_on_held_out_ratings(spark, small):
    small = small.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ratings = ordinal.graded(spark.read.parquet(f"{small}/labels.parquet"))
    model = ordinal.train(docs, ratings.where("doc_id % 4 <> 0"))
    assert model.thresholds[0] < model.thresholds[1]
    held = ordinal.grade_documents(docs, model).join(ratings.where("doc_id % 4 = 0"), "doc_id")
    rows = held.select("grade", "selected", "p_1", "p_2", "expected_grade").collect()
    assert all(r.p_1 >= r.p_2 and abs(r.expected_grade - r.p_1 - r.p_2) < 1e-9 for r in rows)
    good = [r.selected for r in rows if r.grade == 2]
    bad = [r.selected for r in rows if r.grade < 2]
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_ordinal_on_awkward_rows(spark, awkward, clashing):
    none = spark.createDataFrame([(1, None, None), (None, 1, 0), (999, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = ordinal.train(awkward, ordinal.graded(none))
    graded = ordinal.grade_documents(clashing, model)
    assert graded.count() == awkward.count() and graded.select("p_2").distinct().count() == 1


def test_cross_entropy_difference(spark, awkward, clashing):
    rows = [(i, prose(1 + i % 2 * 40 + i // 2, 80)) for i in range(40)]
    rows += [(100 + i, " ".join(f"t{(i * 3 + k) % 9}" for k in range(60))) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    targets = spark.createDataFrame([(100 + i,) for i in range(5)] + [(None,)], "doc_id bigint")
    scores = {r.doc_id: r.difference for r in crossent.score(docs, targets).collect()}
    assert max(scores[i] for i in range(100, 110)) < min(scores[i] for i in range(40))
    found = crossent.score(clashing, spark.createDataFrame([(5,)], "doc_id bigint")).collect()
    assert len(found) == awkward.count() and next(r for r in found if r.doc_id == 0).difference is None


def test_cross_entropy_against_plain_counts(spark, monkeypatch):
    """Losses of every text under the counts of all others."""
    monkeypatch.setattr(crossent, "LEAST_BUCKET_BITS", 3)
    rows = [(i, prose(i % 7, 30 + 60 * (i % 4))) for i in range(24)] + [(24, "Once"), (25, None), (26, " "), (None, "once more")]
    rows += [(3, prose(3, 210))]
    targets = {1, 3, 10, 24}
    docs = [(i, (t or "").lower().split(), i in targets) for i, t in rows]
    grams = lambda w: [(k, g) for b, a in zip([None, *w], w) for k, g in enumerate((a, (b,), (b, a)))]
    every, chosen = Counter(), Counter()
    for _, words, target in docs:
        every.update(grams(words))
        chosen.update(grams(words) if target else [])
    vocabulary = len({g for k, g in every if k == 0})
    total = [sum(len(w) for _, w, t in docs if t), sum(len(w) for _, w, _ in docs)]

    def loss(words, counts, size, scale, held):
        own = Counter(grams(words)) if held else Counter()
        rest, found = scale * (size - (len(words) if held else 0)), 0.0
        for b, a in zip([None, *words], words):
            word, before, pair = (scale * (counts[g] - own[g]) for g in ((0, a), (1, (b,)), (2, (b, a))))
            share = (word + crossent.SMOOTH) / (rest + crossent.SMOOTH * (vocabulary + 1))
            found -= math.log((pair + crossent.TRUST * share) / (before + crossent.TRUST))
        return round(found / len(words), 9)

    expected = Counter()
    for i, words, target in docs:
        two = (None, None)
        if words:
            two = loss(words, chosen, total[0], total[1] / total[0], target), loss(words, every, total[1], 1.0, True)
        expected[i, len(words), *two] += 1
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    marks = spark.createDataFrame([(i,) for i in targets], "doc_id bigint")
    number = lambda x: None if x is None else round(x, 9)
    found = crossent.score(table, marks).collect()
    got = Counter((r.doc_id, r.n_tokens, number(r.target_loss), number(r.background_loss)) for r in found)
    close = lambda c: sorted(((i is None, i or 0, n, round(a or 0, 6), round(b or 0, 6)) for i, n, a, b in c.elements()))
    assert close(got) == close(expected)


def test_cross_entropy_takes_long_texts_in_parts(monkeypatch):
    text = pa.array(["one  Two " + prose(3, 900) + " " * 700 + "two", None])[:1]
    whole = crossent.Block(text, 3)
    monkeypatch.setattr(kernels, "BLOCK_BYTES", 200)
    parts = crossent.Block(text, 3)
    assert np.array_equal(whole.names, parts.names) and np.array_equal(whole.number, parts.number)
    assert np.array_equal(whole.places, parts.places) and np.array_equal(whole.own(), parts.own())


def test_rollup_totals(awkward, clashing):
    tokenizer = bpe._tokenizer(bpe.VOCABULARY)[0]
    rows = sorted(awkward.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    expected, seen = Counter(), set()
    docs = Counter()
    for r in rows:
        if (r.text or "") not in seen:
            seen.add(r.text or "")
            expected[r.source, r.lang] += len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
            docs[r.source, r.lang] += 1
    found = rollup.document_totals(clashing).collect()
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in found} == {k: (docs[k], expected[k]) for k in docs}
    assert {r.tokenizer for r in found} == {bpe.VOCABULARY}


def test_rollup_batches_count_once(spark, tmp_path):
    kinds = "old struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>, new struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>"
    one, more = ("s", None, "v1", 10), ("s", None, "v2", 12)
    store = rollup.Rollup(spark, str(tmp_path / "totals"))
    assert store.totals().count() == 0
    assert store.commit("a", spark.createDataFrame([(None, one), (None, one)], kinds))
    assert not store.commit("a", spark.createDataFrame([(None, one)], kinds))
    assert store.commit("b", spark.createDataFrame([(one, more)], kinds))
    found = {tuple(r) for r in rollup.Rollup(spark, str(tmp_path / "totals")).totals().collect()}
    assert found == {("s", None, "v1", 1, 10), ("s", None, "v2", 1, 12)}


def test_empty_tables(spark, nothing, small):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = ordinal.train(nothing, ordinal.graded(labels))
    assert minhash.near_duplicates(nothing).count() == 0
    assert debruijn.without_repeats(nothing).count() == 0
    assert packing.pack(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert digest.fingerprint_documents(nothing).count() == 0
    assert ordinal.grade_documents(nothing, model).count() == 0
    assert crossent.score(nothing, labels).count() == 0
    assert rollup.document_totals(nothing).count() == 0


def test_pipeline_stages_keep_the_columns(spark, clashing, small):
    rows = clashing
    for name, apply in corpus_pipeline.STAGES[:-1]:
        done = apply(spark, rows, small)
        assert done.columns == clashing.columns, name
        rows = stage(done, name)
    assert corpus_pipeline.STAGES[-1][1](spark, rows, small).count() >= 0


def test_long_texts_in_parts_give_the_same(spark, monkeypatch):
    """Texts far longer than a part, one with a word longer than it, against the plain way."""
    import numpy as np
    import pyarrow as pa

    from tidemill.llm import kernels

    texts = [prose(5, 3_000), prose(6, 700) + " " + "x" * 5_000 + " " + prose(7, 500), "y" * 9_000, "a  b\n" * 2_000, "z " * 3_000]
    plain_ids = [bpe.encode(pa.array([t]))[0] for t in texts]
    plain_sets = [next(kernels.shingle_sets(pa.array([t]), 5)) for t in texts]
    monkeypatch.setattr(kernels, "BLOCK_BYTES", 300)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 300)
    for text, ids, shingles in zip(texts, plain_ids, plain_sets):
        column = pa.array([text])
        assert len(list(kernels.slices(column, 4))) > 3 or " " not in text
        assert np.array_equal(bpe.encode(column)[0], ids)
        assert np.array_equal(next(kernels.shingle_sets(column, 5)), shingles)


def test_repeats_of_long_texts_in_parts(monkeypatch):
    import pyarrow as pa

    from tidemill.llm import kernels

    text = prose(8, 2_000)
    whole = debruijn._Edges(kernels.Words(pa.array([text])), 35)
    edges = whole.hashes(0, 0, 2_000 - 34).tolist()
    monkeypatch.setattr(kernels, "BLOCK_BYTES", 400)
    batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
    found, anchors = {}, set()
    for part, first in debruijn._parts(batch, 35):
        anchors |= set(part.anchor.tolist())
        for start, count in zip(part.start.tolist(), part.edges.tolist()):
            for i, edge in enumerate(part.hashes(0, start, count).tolist()):
                assert first + start + i not in found
                found[first + start + i] = edge
    assert [found[i] for i in range(len(edges))] == edges and len(found) == len(edges)
    assert anchors == set(whole.anchor.tolist())


def test_stage_columns_of_any_name(awkward):
    names = ["__d", "__t", "__spans", "__kept", "__n", "row", "a.b"]
    docs = awkward.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    plain = awkward.columns
    for stage_of in (debruijn.cleaned, minhash.one_of_each):
        left = stage_of(docs)
        assert left.columns == docs.columns
        assert Counter(map(tuple, left.select(*plain).collect())) == Counter(map(tuple, stage_of(awkward).collect()))
        assert {tuple(r) for r in left.select(*[f"`{n}`" for n in names]).collect()} == {tuple(range(len(names)))}


def test_documents_without_ids_are_sampled_apart(spark):
    rows = [(None, f"ten words are in this text of number {i} exactly", "a") for i in range(100)]
    rows += [(i, prose(i, 50), "b") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.source: r for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
    for row in found.values():
        assert abs(row.taken - row.target) <= 0.03 * row.target


def test_short_texts_that_differ_in_a_word_are_alike(spark):
    import pyarrow as pa

    base = "The quick brown fox jumps over the lazy dog near the river"
    texts = [base, base.replace("quick", "slow"), base.replace("lazy", "old"), "Nothing of the kind was ever written by anyone at all", "ab", "ab", ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    ranks = digest.rarity(docs)
    prints = digest.fingerprints(pa.array(texts, pa.large_string()), ranks)
    assert digest.likeness(prints[0], prints[1]) > 0.5 and digest.likeness(prints[0], prints[2]) > 0.5
    assert digest.likeness(prints[0], prints[3]) < 0.25
    assert digest.likeness(prints[4], prints[5]) == 1 and digest.likeness(prints[4], prints[6]) == 0
    rows = {r.doc_id: r for r in digest.fingerprint_documents(docs).collect()}
    assert rows[2].near_next > 0.5 and 0 < rows[1].near_edited < 1


def test_what_a_worker_keeps_of_a_block_is_little():
    """Tables of powers stay with a worker for its life; before, they had 32 bytes for each byte of a full block."""
    kernels._POWERS.clear()
    text = "word " * (kernels.BLOCK_BYTES // 5 + 100)
    kernels.Words(pa.array([text])).hashes()
    kept = sum(table.nbytes for tables in kernels._POWERS.values() for table in tables)
    assert len(text) * 16 <= kept <= 10 << 20
    up, down = kernels.powers(kernels.BYTE_BASE, 3)
    assert up.tolist() == [1, kernels.BYTE_BASE, kernels.BYTE_BASE**2 % 2**64] and int(up[2]) * int(down[2]) % 2**64 == 1


def test_fingerprints_of_many_short_texts_cost_one_pass(monkeypatch):
    """Before, every short text of a block asked for hashes of its own, and large blocks made tables of powers for each."""
    rng = np.random.default_rng(5)
    texts = ["", "a", "short text", "sev seven"[:7], "x" * 600, "é" * 300, "the same " * 80]
    texts += ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(0, 700, 300)]
    texts += ["".join(map(chr, rng.integers(97, 123, n))) for n in (5_000, 40_000, 63, 64, 65, 511, 512, 513)]
    ranks = np.arange(digest.LEVELS + 1)[::-1].copy()
    ranks[: digest.WEAK + 1] = digest.LEVELS + 1
    alone = [digest.fingerprints(pa.array([t], pa.large_string()), ranks)[0] for t in texts]
    asked, own = [], kernels.span_hash
    monkeypatch.setattr(kernels, "span_hash", lambda *given: asked.append(1) or own(*given))
    together = digest.fingerprints(pa.array(texts, pa.large_string()), ranks)
    assert len(asked) <= 2
    monkeypatch.setattr(digest, "_PLACE_BITS", 4)
    wide = digest.fingerprints(pa.array(texts, pa.large_string()), ranks)
    for prints in (together, wide):
        assert all(np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]) for a, b in zip(alone, prints, strict=True))
    pairs = list(zip(alone, alone[1:] + alone[:1]))
    assert digest.likenesses(*zip(*pairs)) == [digest.likeness(a, b) for a, b in pairs]


def test_entropies_are_those_of_each_window():
    rng = np.random.default_rng(6)
    data = np.concatenate((rng.integers(0, 256, 3_000), rng.integers(97, 100, 40_000), np.zeros(200))).astype(np.uint8)
    found = digest.entropies(data)
    assert len(found) == len(data) - 63 and len(digest.entropies(data[:63])) == 0 and len(digest.entropies(data[:64])) == 1
    for at in [0, 1, 2_950, 3_000, 32_767, 32_768, 32_769, len(found) - 1, *rng.integers(0, len(found), 200).tolist()]:
        counts = np.bincount(data[at : at + 64])
        counts = counts[counts > 0]
        bits = 6 - (counts * np.log2(counts)).sum() / 64
        assert abs(found[at] - bits * 1000 / 6) <= 0.51


def test_pieces_in_use_are_encoded_once(monkeypatch):
    """Before, a full cache was emptied and the commonest pieces were encoded again and again."""
    own = bpe._tokenizer.__wrapped__(bpe.VOCABULARY)
    sent = []

    class Counting:
        def encode(self, text, **more):
            sent.append(text)
            return own[0].encode(text, **more)

        def encode_batch_fast(self, texts, **more):
            sent.extend(texts)
            return own[0].encode_batch_fast(texts, **more)

    monkeypatch.setattr(bpe, "_tokenizer", lambda name: (Counting(), *own[1:]))
    monkeypatch.setattr(bpe, "CACHE_BYTES", 200_000)
    common = [f" common{i}." for i in range(300)]
    for block in range(40):
        texts = ["start" + "".join(common) + "\n" + " ".join(f"rare{block}x{i}," for i in range(300)), "", "odd  one", f"first{block} last"]
        texts += [None, "".join(common[block:]), "x" * 2_000 + str(block)]
        ids, bounds = bpe.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == own[0].encode(text or "", add_special_tokens=False).ids
        assert own[2].size() <= bpe.CACHE_BYTES * 5 // 4
    assert own[2].old.names.size and sum(text.count("common") for text in sent) == 300


def test_words_that_the_model_takes_at_once_have_the_same_ids():
    """Letters with a stop after them do not go through the tokenizer's pattern; what is near them does."""
    rng = np.random.default_rng(7)
    signs = list("aabcdeXYZ" "éßÿÀþøŁŉſĀ" "×÷ªµºƀǅЖ日" ".,;:!?)" "'\"-|<>(0²½" "\u0301\u200b\U0001f600") + ["'s", "'ll", "ing", "The", "<|endoftext|>"]
    words = ["".join(rng.choice(signs, n)) for n in rng.integers(1, 8, 6_000)]
    words += ["a", "a.", "!", "don't.", "été,", "Ł", "naïve!", "a×", "×a.", "÷.", "x" * 3_000 + ".", "ok?!", "<|endoftext|>", "a<|endoftext|>."]
    texts = [" ".join(words[i : i + 40]) for i in range(0, len(words), 40)] + words + ["\n".join(words[:500])]
    own = bpe._tokenizer.__wrapped__(bpe.VOCABULARY)
    assert own[3] is not None
    ids, bounds = bpe.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == own[0].encode(text, add_special_tokens=False).ids
