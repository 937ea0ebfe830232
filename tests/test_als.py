import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import als
from tidemill.plans import movies


@pytest.fixture(scope="module")
def coded(spark):
    pick = random.Random(1)
    data = [
        (f"u{u}", i, float(pick.randrange(1, 6)))
        for u in range(20)
        for i in pick.sample(range(15), pick.randrange(2, 10))
    ]
    ratings = spark.createDataFrame(data, "user_id string, item_id int, rating double")
    return als.code_ratings(ratings)


@pytest.fixture(scope="module")
def model(coded):
    return als.fit(coded, rank=4, iterations=5, reg=0.1)


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame([(i, f"t{i}") for i in range(0, 15, 2)], "item_id int, title string")


def factors(df):
    return {r.id: np.array(r.features) for r in df.collect()}


def test_user_factors_solve_their_equations(coded, model):
    """Given the item factors, each user's factors are the regularized least squares solution."""
    items, users = factors(model.itemFactors), factors(model.userFactors)
    rated = {}
    for r in coded.ratings.collect():
        rated.setdefault(r.user_code, []).append((items[r.item_code], r.rating))
    for user, pairs in rated.items():
        v, y = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        solved = np.linalg.solve(v.T @ v + 0.1 * len(pairs) * np.eye(4), v.T @ y)
        assert users[user] == pytest.approx(solved, abs=1e-3)


def test_known_ratings_are_scored_once_each(coded, model):
    scored = als.predict_known(model, coded).collect()
    assert len(scored) == coded.ratings.count()
    error = np.mean([(r.rating - r.prediction) ** 2 for r in scored])
    assert als.mean_squared_error(als.predict_known(model, coded)) == pytest.approx(error)


def test_recommendations_are_the_best_by_dot_product(coded, model):
    users, items = factors(model.userFactors), factors(model.itemFactors)
    user_ids = {r.user_code: r.user_id for r in coded.users.collect()}
    item_ids = {r.item_code: r.item_id for r in coded.items.collect()}
    found = {}
    for r in als.recommend_all_users(model, coded, 3).collect():
        found[r.user_id, r["rank"]] = (r.item_id, r.score)
    assert len(found) == 20 * 3
    for code, vector in users.items():
        best = sorted(((float(vector @ f), item_ids[i]) for i, f in items.items()), reverse=True)
        for at in (1, 2, 3):
            assert found[user_ids[code], at][1] == pytest.approx(best[at - 1][0], abs=1e-4)


def test_some_users(spark, coded, model):
    wanted = spark.createDataFrame([("u1",), ("u1",), ("nobody",)], "user_id string")
    found = als.recommend_some_users(model, coded, wanted).collect()
    assert [r.user_id for r in found] == ["u1"] * 5
    everyone = als.recommend_all_users(model, coded).where("user_id = 'u1'").collect()
    assert {r.item_id for r in found} == {r.item_id for r in everyone}


def test_history_next_to_recommendations(spark, coded, model, titles):
    wanted = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    recommended = als.recommend_some_users(model, coded, wanted)
    both = als.compare_with_history(recommended, coded, wanted, titles)
    seen = {(r.user_id, r.item_id) for r in both.where("kind = 'seen'").collect()}
    rated = coded.ratings.where(F.col("user_id").isin("u1", "u2")).collect()
    assert seen == {(r.user_id, r.item_id) for r in rated if r.item_id % 2 == 0}
    assert all(r.title == f"t{r.item_id}" for r in both.collect())


def test_history_of_users_too_many_to_broadcast(spark, coded, rows, monkeypatch):
    wanted = spark.createDataFrame([("u1",), ("u2",), ("u2",)], "user_id string")
    expected = rows(als.history_of(coded.ratings, wanted), "user_id", "item_id")
    monkeypatch.setattr(als, "fits_broadcast", lambda df: False)
    assert rows(als.history_of(coded.ratings, wanted), "user_id", "item_id") == expected


def test_text_rows(coded, model, titles):
    recommended = als.recommend_all_users(model, coded, 3)
    expected = {}
    for r in sorted(recommended.collect(), key=lambda r: (r.user_id, r["rank"])):
        title = f"t{r.item_id}" if r.item_id % 2 == 0 else ""
        expected.setdefault(r.user_id, []).append(f"{r.item_id}:{title}")
    found = {r.user_id: r.recommendations for r in als.as_text_rows(recommended, titles).collect()}
    assert found == {u: ",".join(entries) for u, entries in expected.items()}


def test_grid(coded):
    found = als.grid(coded, ranks=(2,), regs=(1.0, 0.01), alphas=(1.0, 40.0), iterations=2).collect()
    settings = {(r.mode, r["rank"], r.reg, r.alpha) for r in found}
    assert settings == {("explicit", 2, reg, None) for reg in (1.0, 0.01)} | {
        ("implicit", 2, reg, alpha) for reg in (1.0, 0.01) for alpha in (1.0, 40.0)
    }
    explicit = {r.reg: r.mse for r in found if r.mode == "explicit"}
    assert explicit[0.01] < explicit[1.0]


def test_same_seed_same_model(coded, model):
    again = factors(als.fit(coded, rank=4, iterations=5, reg=0.1).userFactors)
    for user, vector in factors(model.userFactors).items():
        assert again[user] == pytest.approx(vector, abs=1e-4)


def test_movie_jobs_from_text(spark, tmp_path):
    lines = [f"u{u}, {i}, {(u * i) % 6 - 1}" for u in range(8) for i in range(1, 7) if (u + i) % 3]
    (tmp_path / "ratings.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "movies.csv").write_text("1,8.1,One\n2,7.0,Two, again\n,1,none\n")
    ratings, titles = movies.load_movies(
        spark, str(tmp_path / "ratings.csv"), str(tmp_path / "movies.csv")
    )
    profile = movies.profile(ratings)
    assert tuple(profile["users"].first())[:2] == (8, 3.5)
    assert tuple(profile["items"].first())[:2] == (6, 3.5)
    wanted = spark.createDataFrame([("u1",)], "user_id string")
    both = movies.check(ratings, titles, wanted, rank=2, iterations=2)
    assert {r.kind for r in both.collect()} == {"seen", "recommended"}
    movies.recommend(ratings, titles, str(tmp_path / "out"), rank=2, iterations=2)
    files = sorted((tmp_path / "out" / "result").glob("part-*"))
    written = "".join(f.read_text() for f in files).splitlines()
    assert [w.split(",")[0] for w in written] == [f"u{u}" for u in range(8)]
    assert all(w.count(":") == 5 for w in written)
    assert als.load(str(tmp_path / "out" / "model")).rank == 2


def test_unseen_items_only_as_many_as_there_are(spark, coded, model):
    rated = {(r.user_id, r.item_id) for r in coded.ratings.collect()}
    found = als.recommend_unseen(model, coded, 8).collect()
    assert not {(r.user_id, r.item_id) for r in found} & rated
    items, scores = coded.items.count(), {}
    for r in als.recommend_all_users(model, coded, items).collect():
        scores.setdefault(r.user_id, []).append((r.rank, r.item_id))
    for user in {u for u, _ in rated}:
        own = [r.item_id for r in sorted((r for r in found if r.user_id == user), key=lambda r: r.rank)]
        best = [i for _, i in sorted(scores[user]) if (user, i) not in rated]
        assert own == best[:8]  # the same as dropping rated items from the whole ranking


def test_unseen_for_some_users(spark, coded, model):
    wanted = spark.createDataFrame([("u3",), ("nobody",)], "user_id string")
    found = als.recommend_unseen(model, coded, 3, wanted).collect()
    assert [r.rank for r in sorted(found, key=lambda r: r.rank)] == [1, 2, 3] and {r.user_id for r in found} == {"u3"}
    assert als.recommend_unseen(model, coded, 3, wanted.where("user_id = 'nobody'")).count() == 0


def test_holdout_keeps_a_rating_of_every_user_and_item(spark):
    pick = random.Random(5)
    cells = [(f"u{u}", i, 1.0) for u in range(30) for i in pick.sample(range(12), pick.randrange(1, 9))]
    ratings = spark.createDataFrame(cells + cells[:5] + [("u1", None, 2.0)], "user_id string, item_id int, rating double")
    split = als.split_holdout(ratings, 0.9).collect()
    assert len(split) == len(cells) + 5
    held = {(r.user_id, r.item_id) for r in split if r.held}
    trained = {(r.user_id, r.item_id) for r in split if not r.held}
    assert not held & trained and len(held) > 0.5 * len(cells)
    assert {u for u, _ in trained} == {u for u, _, _ in cells}
    assert {i for _, i in trained} == {i for _, i, _ in cells}
    assert sorted(als.split_holdout(ratings.repartition(3), 0.9).collect()) == sorted(split)
    assert sorted(als.split_holdout(ratings, 0.9, "other").collect()) != sorted(split)


def test_holdout_of_learnable_ratings(spark):
    """Ratings that are a product of a user's and an item's factor are predicted from the others."""
    cells = [(u, i, (1 + u % 5) * (1 + i % 4) / 2.0) for u in range(40) for i in range(20) if (u * 7 + i * 3) % 4]
    found = als.evaluate_holdout(spark.createDataFrame(cells, "user_id int, item_id int, rating double"), rank=2, reg=0.01).first()
    assert found.held > 50 and found.mse < 0.1 * found.mean_mse
    assert 0 < found.precision <= 1 and 0 < found.recall <= 1 and 0 < found.ndcg <= 1


def test_ranges_go_on_where_they_stopped(spark, coded, model, tmp_path, monkeypatch):
    folder = str(tmp_path / "ranges")
    calls = []

    def ranked(frame, own):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(frame, own)

    real = als._ranked
    with monkeypatch.context() as patch:
        patch.setattr(als, "_ranked", ranked)
        with pytest.raises(RuntimeError):
            als.recommend_in_ranges(model, coded, folder, 3, users_per_range=6)
    assert als.recommend_in_ranges(model, coded, folder, 3, users_per_range=6, most=0).count() == 2 * 6 * 3
    whole = als.recommend_in_ranges(model, coded, folder, 3, users_per_range=6)
    assert sorted(whole.collect()) == sorted(als.recommend_all_users(model, coded, 3).collect())
    with pytest.raises(ValueError):
        als.recommend_in_ranges(model, coded, folder, 4, users_per_range=6)


def test_a_side_of_few_keys_gets_few_blocks(model):
    """Factors of the other side are sent to each block: 15 items take two blocks, 20 users three."""
    assert (model.itemFactors.rdd.getNumPartitions(), model.userFactors.rdd.getNumPartitions()) == (2, 3)
    assert [als.block_count(n) for n in (0, 1, 25, 128, 900_000, 5_400_000)] == [1, 1, 4, 16, 16, 54]


def test_shuffled_factors_are_let_go_after_two_iterations(coded, monkeypatch):
    asked, solver = {}, als.ALS
    monkeypatch.setattr(als, "ALS", lambda **settings: asked.update(settings) or solver(**settings))
    als.fit(coded, rank=2, iterations=2)
    assert asked["checkpointInterval"] == 2 and (asked["numUserBlocks"], asked["numItemBlocks"]) == (3, 2)
