"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import crossent, debruijn, digest, extract, forest, manifest, minhash, mixing, ordinal, packing, rollup, tokenfiles, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


@query
def op2_digest(spark: SparkSession, folder: str) -> DataFrame:
    return digest.fingerprint_documents(_table(spark, folder, "documents"))


@query
def op3_forest(spark: SparkSession, folder: str) -> DataFrame:
    return forest.near_vectors(_table(spark, folder, "embeddings"), least=0.98)


@query
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), words=2, percent=80)


@query
def op5_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.document_totals(_table(spark, folder, "documents"))


@query
def op6_crossent(spark: SparkSession, folder: str) -> DataFrame:
    """Good, harmless documents as the target, all documents as the background."""
    labels = _table(spark, folder, "labels")
    return crossent.score(_table(spark, folder, "documents"), labels.where("quality > 0 and toxic = 0"))


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(_table(spark, folder, "pages"))


@query
def op9_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = ordinal.train(docs, ordinal.graded(_table(spark, folder, "labels")))
    graded = ordinal.grade_documents(docs, model)
    return graded.select("doc_id", "expected_grade", "p_1", "p_2", "selected")


@query
def op10_debruijn(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn.without_repeats(_table(spark, folder, "documents"), size=35)


@query
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.round_trip(_table(spark, folder, "documents"))


@query
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every row proved against the manifest of the untampered table."""
    return manifest.proofs(_table(spark, folder, "documents"), {"n_chars": manifest.tampered_n_chars()})


_CRC32 = """
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(@)::BIGINT), lambda i: ord(substr(@, i::INT + 1, 1))::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k:
            xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))
"""


def crc32_sql(text: str) -> str:
    """Checksum of an ASCII string that is not empty, as unsigned 32-bit number."""
    return f"xor({_CRC32.replace('@', text)}, 4294967295::BIGINT)"


def _field_sql(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


ORACLES["op12_manifest"] = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree,
        sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', 'n_chars', 'text')))}) AS leaf,
        sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', 'n_chars + hit', 'text')))}) AS now
    FROM (SELECT *, CASE WHEN doc_id IS NOT NULL AND {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN 1 ELSE 0 END AS hit
          FROM documents)
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
), nodes AS (
    SELECT tree, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
    UNION ALL
    SELECT tree, any_value(level) + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY tree, place // 2
), subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, place, digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT any_value(level) + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 1) // 2
    FROM tops WHERE n > 1 GROUP BY place // 2
), steps AS (
    SELECT l.doc_id, l.leaf, l.place, l.tree, n.level, n.digest, xor(l.place >> n.level, 1) < l.place >> n.level AS before
    FROM leaves l JOIN nodes n ON n.tree = l.tree AND n.place = xor(l.place >> n.level, 1)
    UNION ALL
    SELECT l.doc_id, l.leaf, l.place, l.tree, 1000 + t.level, t.digest, xor(s.place >> t.level, 1) < s.place >> t.level
    FROM leaves l JOIN subroots s USING (tree) JOIN tops t ON t.place = xor(s.place >> t.level, 1)
), heights AS (
    SELECT tree, max(level) AS height FROM nodes GROUP BY tree
), folded AS (
    SELECT l.tree, l.place, l.now AS digest, 0 AS level, h.height, (SELECT max(level) FROM tops) AS more
    FROM leaves l JOIN heights h USING (tree)
    UNION ALL
    SELECT f.tree, f.place, sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN s.before THEN s.digest || f.digest
        ELSE f.digest || s.digest END), f.level + 1, f.height, f.more
    FROM folded f LEFT JOIN steps s ON s.tree = f.tree AND s.place = f.place
        AND s.level = CASE WHEN f.level < f.height THEN f.level ELSE 1000 + f.level - f.height END
    WHERE f.level < f.height + f.more
), proofs AS (
    SELECT tree, place, string_agg(digest, '' ORDER BY level) AS proof FROM steps GROUP BY tree, place
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    f.digest AS folded_root, f.digest = r.digest AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN folded f ON f.tree = l.tree AND f.place = l.place AND f.level = f.height + f.more
LEFT JOIN proofs p ON p.tree = l.tree AND p.place = l.place, (SELECT digest FROM tops WHERE n = 1) r
"""


@query
def op13_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, folder, "conversations"))


ORACLES["op13_trie"] = f"""
WITH own AS (
    SELECT conv_id, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h, conv_id - conv_id % 20 AS base, turns
    FROM (SELECT conv_id, list({{'k': octet_length(encode(role)) || ':' || role || text,
              'w': len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))}} ORDER BY turn NULLS FIRST) AS turns
          FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
          WHERE conv_id IS NOT NULL GROUP BY conv_id)
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM own c LEFT JOIN own b ON b.conv_id = c.base
), members AS (
    SELECT conv_id, d, list_transform(turns[1:d], lambda x: x.k) AS path, turns[d].w AS w, d = len(turns) AS ends
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(w), 0) AS w,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends
    FROM members GROUP BY path
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
    SELECT path[1:up] AS path, sum((n - 1) * w) AS saved, count(*) FILTER (childless) AS leaves
    FROM (SELECT n.path, n.n, n.w, c.path IS NULL AS childless, unnest(range(0, depth + 1)) AS up
          FROM nodes n LEFT JOIN children c ON c.path = n.path)
    GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
    b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""


_REACHABLE = """
reach AS (
    SELECT a AS node, a AS other FROM nodes
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
)"""


ORACLES["op3_forest"] = f"""
WITH RECURSIVE sound AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM sound p JOIN sound q ON p.label = q.label AND p.vec_id <> q.vec_id
    WHERE list_cosine_similarity(p.v, q.v) >= 0.98
), nodes AS (SELECT DISTINCT a FROM links), {_REACHABLE}
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.least, e.vec_id) AS component_id, coalesce(c.least, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT node, min(other) AS least FROM reach GROUP BY node) c ON c.node = e.vec_id
"""

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op4_minhash"] = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_transform({_WORDS}, lambda x: translate(x, '{_UPPER}', '{_LOWER}')) AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 1 THEN [words[1]]
        ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS s
    FROM worded WHERE len(words) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common c JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c.n >= 80 * (p.n + q.n - c.n)
), nodes AS (SELECT DISTINCT a FROM links), {_REACHABLE}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id, coalesce(c.least, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT node, min(other) AS least FROM reach GROUP BY node) c ON c.node = d.doc_id
"""

ORACLES["op10_debruijn"] = f"""
WITH worded AS (
    SELECT doc_id, row_number() OVER () AS id, {_WORDS} AS words FROM documents
), windows AS (
    SELECT id, i, md5(array_to_string(words[i:i + 34], ' ')) AS h FROM (SELECT id, words, unnest(range(1, len(words) - 33)) AS i FROM worded)
), gone AS (
    SELECT DISTINCT id, unnest(range(i, i + 35)) AS place FROM windows
    WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), kept AS (
    SELECT w.id, count(g.place) AS removed, coalesce(string_agg(word, ' ' ORDER BY w.place) FILTER (WHERE g.place IS NULL), '') AS rest
    FROM (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM worded) w
    LEFT JOIN gone g ON g.id = w.id AND g.place = w.place GROUP BY w.id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(k.removed, 0) AS n_removed, sha256(coalesce(k.rest, '')) AS kept_sha256
FROM worded w LEFT JOIN kept k ON k.id = w.id
"""
