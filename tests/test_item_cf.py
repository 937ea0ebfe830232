import math
import re
import random
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators import ranking, scoring, similarity
from tidemill.plans import item_cf
from tidemill.session import stage

# Twelve preferences, all 1: every item has three users.
SAMPLE = {"1": "12", "2": "13", "3": "34", "4": "24", "5": "123", "6": "4"}


@pytest.fixture(scope="module")
def sample(spark):
    data = [(u, i, 1.0) for u, items in SAMPLE.items() for i in items]
    return spark.createDataFrame(data, schemas.PREFS)


def random_prefs(seed, users=25, items=12, repeats=True):
    """User u0 has a third of all rows; preferences repeat."""
    pick = random.Random(seed)
    data = []
    for u in range(users):
        for _ in range(pick.randrange(1, 8) if u else users * 2):
            item = f"i{pick.randrange(items)}"
            data.append((f"u{u}", item, float(pick.randrange(0, 6))))
    return data if repeats else list({(u, i): (u, i, p) for u, i, p in data}.values())


def brute_force(data, method):
    """Similarities from all pairs of preference rows of a user."""
    by_user = defaultdict(list)
    for user, item, pref in data:
        by_user[user].append((item, pref))
    n, dot, squares = defaultdict(float), defaultdict(float), defaultdict(float)
    for prefs in by_user.values():
        for (i, x), (j, y) in product(prefs, prefs):
            n[i, j] += 1
            dot[i, j] += x * y
            squares[i, j] += (x - y) ** 2
    result = {}
    for i, j in n:
        if i == j:
            continue
        if method == "cooccurrence":
            result[i, j] = n[i, j] / math.sqrt(n[i, i] * n[j, j])
        elif method == "cosine":
            norm = math.sqrt(dot[i, i] * dot[j, j])
            if norm:
                result[i, j] = dot[i, j] / norm
        else:
            result[i, j] = n[i, j] / (1 + math.sqrt(squares[i, j]))
    return result


def similar(df):
    return {(r.item_id1, r.item_id2): r.similar for r in df.collect()}


@pytest.mark.parametrize(
    "method, two, one", [("cooccurrence", 2 / 3, 1 / 3), ("cosine", 2 / 3, 1 / 3), ("euclidean", 2, 1)]
)
def test_sample_similarities(sample, method, two, one):
    half = {("1", "2"): two, ("1", "3"): two, ("2", "3"): one, ("2", "4"): one, ("3", "4"): one}
    expected = {**half, **{(j, i): v for (i, j), v in half.items()}}
    assert similar(similarity.item_similarity(sample, method)) == pytest.approx(expected)


@pytest.mark.parametrize(
    "data, dedupe, expected",
    [
        ("Ap2 Aq3 Bp4 Bq1", None, (1.0, 10 / math.sqrt(200), 2 / (1 + math.sqrt(10)))),
        ("Ap1 Ap1 Aq1 Bp1", None, (2 / math.sqrt(5), 2 / math.sqrt(5), 2.0)),
        ("Ap1 Ap1 Aq1 Bp1", "max", (1 / math.sqrt(2), 1 / math.sqrt(2), 1.0)),
        ("Ap1 Ap1 Aq1 Bp1", "sum", (1 / math.sqrt(2), 2 / math.sqrt(5), 1 / 2)),
        ("Ap0 Aq3", None, (1.0, None, 0.25)),
    ],
)
def test_small_cases(spark, data, dedupe, expected):
    prefs = spark.createDataFrame([(d[0], d[1], float(d[2])) for d in data.split()], schemas.PREFS)
    for method, value in zip(("cooccurrence", "cosine", "euclidean"), expected, strict=True):
        found = similar(similarity.item_similarity(prefs, method, dedupe))
        assert found == ({} if value is None else pytest.approx({("p", "q"): value, ("q", "p"): value}))


@pytest.mark.parametrize("method", ["cooccurrence", "cosine", "euclidean"])
@pytest.mark.parametrize("sizes", [{}, {"items_per_block": 3, "rows_per_slice": 4}])
def test_similarities_match_brute_force(spark, method, sizes):
    data = random_prefs(seed=11)
    found = similar(similarity.item_similarity(spark.createDataFrame(data, schemas.PREFS), method, **sizes))
    assert found == pytest.approx(brute_force(data, method))


def test_large_equal_preferences_have_no_distance(spark):
    data = [(u, i, 123456789.1) for u in "ab" for i in "pq"]
    found = similar(similarity.item_similarity(spark.createDataFrame(data, schemas.PREFS), "euclidean"))
    assert found == {("p", "q"): 2.0, ("q", "p"): 2.0}


def test_incomplete_preferences_are_left_out(spark):
    data = [("a", "p", 1.0), ("a", "q", 1.0), (None, "q", 1.0), ("a", None, 1.0), ("b", "p", None)]
    found = similar(similarity.item_similarity(spark.createDataFrame(data, schemas.PREFS)))
    assert found == {("p", "q"): 1.0, ("q", "p"): 1.0}


def test_users_with_many_items_are_cut_into_blocks(spark):
    data = [("busy", f"i{n}", 1.0) for n in range(40)] + [("idle", "i1", 1.0), ("idle", "i2", 1.0)]
    cells = similarity.rating_cells(spark.createDataFrame(data, schemas.PREFS))
    heavy = similarity.heavy_in_table(cells, "user_id", 10)
    pairs = similarity.pair_rows(cells, ["n"], heavy).cache()
    assert pairs.count() == 40 * 39 // 2 + 1
    assert pairs.select("user_id", "item_id1", "item_id2").distinct().count() == pairs.count()
    busy = pairs.where("user_id = 'busy'").groupBy("_block1", "_block2").count().collect()
    assert len(busy) == 16 and max(r["count"] for r in busy) < 200
    pairs.unpersist()


def test_unknown_names_are_refused(sample):
    with pytest.raises(ValueError):
        similarity.item_similarity(sample, "jaccard")
    with pytest.raises(ValueError):
        similarity.rating_cells(sample, "min")


def test_pair_counts(sample):
    counts = {(r.item_id1, r.item_id2): r.pairs for r in similarity.pair_counts(sample).collect()}
    assert counts["1", "1"] == 3 and counts["1", "2"] == counts["2", "1"] == 2
    assert ("1", "4") not in counts and len(counts) == 14


RECOMMENDED = {
    "1": [("3", 1.0), ("4", 1 / 3)],
    "2": [("2", 1.0), ("4", 1 / 3)],
    "3": [("1", 2 / 3), ("2", 2 / 3)],
    "4": [("1", 2 / 3), ("3", 2 / 3)],
    "5": [("4", 2 / 3)],
    "6": [("2", 1 / 3), ("3", 1 / 3)],
}


@pytest.mark.parametrize("n", [1, 2, 30])
def test_sample_recommendations(sample, n):
    _, recs = item_cf.similarities_and_recommendations(sample, n=n)
    found = {(r.user_id, r["rank"]): (r.item_id, r.pref) for r in recs.collect()}
    expected = {(u, at): r for u, rs in RECOMMENDED.items() for at, r in enumerate(rs[:n], 1)}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    assert [found[k][1] for k in sorted(found)] == pytest.approx([expected[k][1] for k in sorted(found)])


def test_all_recommendations_are_ordered(sample):
    found = scoring.recommend_all(similarity.item_similarity(sample), sample).collect()
    keys = [(r.user_id, r.pref, r.item_id) for r in found]
    assert len(keys) == 11 and keys == sorted(keys)


@pytest.mark.parametrize("sizes", [{}, {"broadcast_rows": 5}, {"broadcast_rows": 5, "terms_per_task": 40}])
def test_scores_match_brute_force(spark, sizes):
    data = random_prefs(seed=5, users=18, items=30)
    sims = brute_force(data, "cooccurrence")
    held = {(u, i) for u, i, _ in data}
    expected = defaultdict(float)
    for user, item, pref in data:
        for (i, j), value in sims.items():
            if i == item and (user, j) not in held:
                expected[user, j] += pref * value
    prefs = spark.createDataFrame(data, schemas.PREFS)
    table = spark.createDataFrame([(i, j, v) for (i, j), v in sims.items()], schemas.SIMS)
    found = scoring.recommend_all(table, prefs, **sizes).collect()
    assert {(r.user_id, r.item_id): r.pref for r in found} == pytest.approx(dict(expected))
    top = scoring.recommend_top(table, prefs, 2, **sizes).collect()
    best = defaultdict(list)
    for (user, item), score in expected.items():
        best[user].append((-round(score, 9), item))
    assert {(r.user_id, r["rank"], r.item_id) for r in top} == {
        (u, at, item) for u, rs in best.items() for at, (_, item) in enumerate(sorted(rs)[:2], 1)
    }


@pytest.fixture
def no_broadcast(spark):
    """Tables as good as too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_terms_are_not_shuffled(spark, no_broadcast):
    data = random_prefs(seed=5, users=18, items=30, repeats=False)
    prefs = spark.createDataFrame(data, schemas.PREFS)
    held = stage(scoring.user_items(prefs), "held")
    sims = similarity.item_similarity(prefs)
    small = scoring.unseen_scores(sims, held)
    # Rows, links and held items are moved to their cells; nothing is moved after that.
    gridded = scoring.unseen_scores(sims, held, broadcast_rows=5, terms_per_task=40)
    plan = gridded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("shufflepartitionidpassthrough") == 3
    assert gridded.rdd.getNumPartitions() > 10
    exact = {(r.user_id, r.item_id): r.pref for r in small.collect()}
    assert {(r.user_id, r.item_id): r.pref for r in gridded.collect()} == pytest.approx(exact)


def test_grid_follows_the_sizes_of_both_tables(spark):
    held = spark.range(1000).selectExpr("id AS user_id", "id % 10 AS item_id", "1D AS total")
    edges = spark.range(10).selectExpr("id AS item_id", "id + 1 AS item_id2", "1D AS similar")
    assert scoring.grid_size(edges, held, 10) == (100, 1)
    many = edges.withColumn("item_id2", F.explode(F.sequence(F.lit(1), F.lit(10000))))
    shards, blocks = scoring.grid_size(many, held, 100_000)
    assert blocks > shards and shards * blocks >= 100
    assert scoring.grid_size(edges.limit(0), held, 10)[1] == 1


def test_nearly_equal_scores_are_ties(spark):
    df = spark.createDataFrame([("u", "b", 0.1 + 0.2), ("u", "a", 0.3)], "k string, i string, s double")
    assert ranking.top_per_key(df, "k", "s", "i", 1).first().i == "a"


def test_top_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS i", "double(id) AS s")
    plan = ranking.top_per_key(df, "k", "s", "i", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Python" not in plan


def test_from_text(spark, tmp_path):
    lines = [f"{u},{i},1" for u, items in SAMPLE.items() for i in items]
    (tmp_path / "prefs").write_text("\n".join(lines) + "\n")
    results = item_cf.item_cf_from_text(spark, str(tmp_path / "prefs"))
    assert results["similarities"].count() == 10
    assert results["recommendations"].count() == 11


@pytest.mark.parametrize("method", ["cooccurrence", "cosine", "euclidean"])
@pytest.mark.parametrize("sizes", [{}, {"items_per_block": 3, "rows_per_slice": 4, "pairs_per_task": 40}])
def test_items_that_seldom_meet_are_gathered(spark, method, sizes):
    data = random_prefs(seed=3, users=30, items=60, repeats=True)
    cells = stage(similarity.rating_cells(spark.createDataFrame(data, schemas.PREFS)), "cells")
    for by_item in (False, True):
        df = similarity.similarity_of_cells(cells, method, by_item=by_item, **sizes)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and not re.search(r"Exchange hashpartitioning\(item_id1#\d+, item_id2", plan)
        assert similar(df) == pytest.approx(brute_force(data, method))


def test_nearest_items_move_no_pairs(spark):
    data = random_prefs(seed=5, users=30, items=60, repeats=True)
    prefs = spark.createDataFrame(data, schemas.PREFS)
    found = similarity.nearest_items(prefs, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(item_id[12]", plan)) == 1
    assert similar(found) == similar(similarity.nearest(similarity.item_similarity(prefs), 4))


def test_parts_give_all_their_pairs(spark, small):
    from tidemill.catalog import recommend

    found = recommend.sim_cooccurrence_parts(spark, small)
    assert found.columns == ["item_id1", "item_id2", "similar"]
    pairs = set(similar(found))
    assert len(pairs) == found.count() and all((j, i) in pairs for i, j in pairs)
