"""Token files against the tokenizer itself, and the grammar by round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import repair, tokenfiles, wordbpe
from tidemill.llm.queries import QUERIES
from tidemill.session import new_folder

TEXTS = [
    None, "", " \n ", "it's <|endoftext|>x y", "don't Stop 12345abc!!,, é ǘ", "\x1c a\x00b <x></w> ok",
    "İstanbul ΣΑΣ ſ   x y", "a" * 3000, "ÀÉß×÷ÿ naïve é", "the same words " * 400,
]


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(wordbpe.VOCABULARY))


def expected(rows):
    """Rows as they should come out, for ``(doc_id, text)`` in file order."""
    own, at, out = tokenizer(), 0, []
    for doc, text in rows:
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(None, "no id")] + [(i, t) for i, t in enumerate(TEXTS)] + [(50, "twice"), (50, "twice")]
    frame = spark.createDataFrame(rows[::-1], "doc_id bigint, text string")
    return rows, frame.withColumns({c: F.lit("mine") for c in ("row", "ids", "piece", "part", "grammar")})


@pytest.mark.parametrize("block_ids", [1 << 20, 97])
def test_documents_come_back(awkward, block_ids):
    rows, frame = awkward
    got = [tuple(r) for r in tokenfiles.round_trip(frame, block_ids=block_ids).orderBy("start").collect()]
    assert got == expected(rows)


def test_query_on_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op11_repair"](spark, small).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected([tuple(r) for r in docs])


def test_empty_table(awkward):
    assert tokenfiles.round_trip(awkward[1].limit(0)).count() == 0


def test_few_documents_without_the_rest(spark, awkward):
    rows, frame = awkward
    path = new_folder(spark, "token-test")
    tokenfiles.write_tokens(frame, path, block_ids=97)
    got = tokenfiles.token_ids(tokenfiles.read_blocks(spark, path), [4, 9, 999]).orderBy("part", "block", "at").collect()
    for doc in (4, 9):
        ids = [i for r in got if r.doc_id == doc for i in r.ids]
        assert ids == tokenizer().encode(TEXTS[doc], add_special_tokens=False).ids + [2]
    assert {r.doc_id for r in got} == {4, 9}


def test_long_texts_in_slices(monkeypatch):
    monkeypatch.setattr(wordbpe, "SLICE_BYTES", 50)
    monkeypatch.setattr(wordbpe, "CACHE_BYTES", 2_000)
    texts = [t or "" for t in TEXTS] + ["word" * 40 + " ends", "Ünï cödé " * 30]
    found = [[] for _ in texts]
    for text, ids in wordbpe.encoder().encode(pa.array(texts)):
        found[text].extend(ids.tolist())
    own = tokenizer()
    assert found == [own.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_grammar(seed):
    rng = np.random.default_rng(seed)
    ids = rng.zipf(1.3, 20_000) % 50
    if seed == 0:
        ids = np.full(5_000, 7)
    grammar = repair.Grammar.from_bytes(repair.compress(ids, 50, least=4).to_bytes())
    assert np.array_equal(grammar.expand(), ids)
    assert len(grammar.sequence) < len(ids) / 1.5
    assert grammar.ends()[-1] == len(ids)
    for start, stop in [(0, 1), (0, len(ids)), (17, 1_234), (4_998, 5_000)]:
        assert np.array_equal(grammar.span(start, stop), ids[start:stop])


def test_grammar_of_little():
    for ids in ([], [3], [1, 2, 3]):
        grammar = repair.Grammar.from_bytes(repair.compress(np.array(ids, np.int64), 1 << 17).to_bytes())
        assert grammar.expand().tolist() == ids
    with pytest.raises(ValueError):
        repair.Grammar.from_bytes(b"something else")
