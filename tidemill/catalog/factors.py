"""Matrix factorization. Factors depend on the seed, so the SQL checks what must hold of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.tables import brand_titles, line_prefs, registrar, table, text
from tidemill.operators import als
from tidemill.session import new_folder, stage

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)


def ratings(spark, folder):
    """A customer's mean quantity of a brand as the rating."""
    return (
        line_prefs(spark, folder)
        .groupBy("user_id", "item_id")
        .agg(F.avg("pref").alias("rating"))
    )


_RATINGS = """(
SELECT CAST(o_custkey AS VARCHAR) AS user_id, p_brand AS item_id, avg(l_quantity) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2)"""


@query(f"SELECT user_id, item_id, round(rating, 6) AS rating, true AS predicted FROM {_RATINGS}")
def als_explicit(spark, folder):
    coded = als.code_ratings(ratings(spark, folder))
    return _with_flag(als.predict_known(als.fit(coded), coded))


@query(f"SELECT user_id, item_id, round(rating, 6) AS rating, true AS predicted FROM {_RATINGS}")
def als_implicit(spark, folder):
    coded = als.code_ratings(ratings(spark, folder))
    model = als.fit(coded, rank=10, reg=0.01, implicit=True)
    return _with_flag(als.predict_known(model, coded))


def _with_flag(predictions):
    known = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return predictions.select(
        "user_id", "item_id", F.round("rating", 6).alias("rating"), known.alias("predicted")
    )


@query(f"SELECT count(*) AS rated, true AS better_than_mean FROM {_RATINGS}")
def als_mse(spark, folder):
    """The fit explains the ratings better than their mean does: error below variance."""
    coded = als.code_ratings(ratings(spark, folder))
    predictions = als.predict_known(als.fit(coded, rank=10, reg=0.01), coded)
    error = als.mean_squared_error(predictions)
    return coded.ratings.agg(
        F.count("*").alias("rated"), (F.var_pop("rating") > error).alias("better_than_mean")
    )


@query(
    """
SELECT 'explicit' AS mode, r AS rank, l AS reg, NULL::DOUBLE AS alpha, true AS has_error
FROM (VALUES (10), (50)) a(r), (VALUES (1.0::DOUBLE), (0.01), (0.0001)) b(l)
UNION ALL
SELECT 'implicit', r, l, x, true
FROM (VALUES (10), (50)) a(r), (VALUES (1.0::DOUBLE), (0.01), (0.0001)) b(l),
     (VALUES (1.0::DOUBLE), (40.0)) c(x)"""
)
def als_grid(spark, folder):
    """An explicit fit must err less than the mean rating does; an implicit error only has to be a number."""
    coded = als.code_ratings(ratings(spark, folder))
    spread = coded.ratings.agg(F.var_pop("rating")).first()[0]
    error = F.col("mse")
    better = F.when(F.col("mode") == "explicit", error < spread).otherwise(error >= 0)
    has_error = ~F.isnan(error) & better
    return als.grid(coded).select("mode", "rank", "reg", "alpha", has_error.alias("has_error"))


def _wanted(spark, folder):
    customers = table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return customers.select(text("c_custkey").alias("user_id"))


_FIVE_EACH = "count(*) AS users, true AS five_each, true AS items_differ, true AS items_known"


def _five_each(recommended, known_items):
    """Per-user checks of recommendation rows, reduced to one row."""
    strange = recommended.join(known_items.select("item_id").distinct(), "item_id", "left_anti")
    per_user = recommended.groupBy("user_id").agg(
        F.count("*").alias("n"), F.countDistinct("item_id").alias("different")
    )
    checked = per_user.agg(
        F.count("*").alias("users"),
        F.every(F.col("n") == 5).alias("five_each"),
        F.every(F.col("n") == F.col("different")).alias("items_differ"),
    )
    # Both sides are one-row totals.
    return checked.join(strange.agg((F.count("*") == 0).alias("items_known")), how="inner")


@query(
    f"""
SELECT {_FIVE_EACH} FROM (
  SELECT DISTINCT o_custkey FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING')"""
)
def als_user_subset(spark, folder):
    rated = ratings(spark, folder)
    coded = als.code_ratings(rated)
    model = als.fit(coded, rank=10, reg=0.01)
    return _five_each(als.recommend_some_users(model, coded, _wanted(spark, folder)), coded.ratings)


@query(
    f"""
SELECT user_id, r.item_id, title FROM {_RATINGS} r
JOIN customer ON user_id = CAST(c_custkey AS VARCHAR) AND c_mktsegment = 'BUILDING'
JOIN (SELECT p_brand AS item_id, min(p_name) AS title FROM part WHERE p_size = 1 GROUP BY 1) t
  ON t.item_id = r.item_id"""
)
def als_seen_titles(spark, folder):
    """The seen half of the comparison of history and recommendations."""
    coded = als.code_ratings(ratings(spark, folder))
    wanted = _wanted(spark, folder)
    model = als.fit(coded, rank=10, reg=0.01)
    recommended = als.recommend_some_users(model, coded, wanted)
    both = als.compare_with_history(recommended, coded, wanted, brand_titles(spark, folder))
    return both.where(F.col("kind") == "seen").select("user_id", "item_id", "title")


@query(
    f"""
SELECT {_FIVE_EACH} FROM (
  SELECT DISTINCT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""
)
def als_recommend_all(spark, folder):
    coded = als.code_ratings(ratings(spark, folder))
    model = als.fit(coded, rank=10, reg=0.01)
    return _five_each(als.recommend_all_users(model, coded), coded.ratings)


@query(
    """
SELECT CAST(o_custkey AS VARCHAR) AS user_id, 5 AS entries FROM orders
JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"""
)
def als_recommendation_text(spark, folder):
    """Every user's text row, with the number of ``id:title`` entries in it."""
    coded = als.code_ratings(ratings(spark, folder))
    model = als.fit(coded, rank=10, reg=0.01)
    rows = als.as_text_rows(als.recommend_all_users(model, coded), brand_titles(spark, folder))
    entries = F.regexp_count("recommendations", F.lit("Brand#[0-9]+:")).alias("entries")
    return rows.select("user_id", entries)


@query(
    """
SELECT 'users' AS side, count(DISTINCT o_custkey) AS factors, 10 AS rank, true AS unchanged
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL
SELECT 'items', count(DISTINCT p_brand), 10, true FROM part JOIN lineitem ON l_partkey = p_partkey"""
)
def als_save_load(spark, folder):
    """Factors before saving and after loading are the same."""
    model = als.fit(als.code_ratings(ratings(spark, folder)), rank=10, reg=0.01)
    path = new_folder(spark, "model")
    als.save(model, path)
    loaded = als.load(path)
    sides = [
        ("users", model.userFactors, loaded.userFactors),
        ("items", model.itemFactors, loaded.itemFactors),
    ]
    checks = [
        before.join(after.withColumnRenamed("features", "again"), "id")
        .agg(
            F.count("*").alias("factors"),
            F.max(F.size("features")).alias("rank"),
            F.every(F.col("features") == F.col("again")).alias("unchanged"),
        )
        .select(F.lit(side).alias("side"), "factors", "rank", "unchanged")
        for side, before, after in sides
    ]
    return checks[0].unionByName(checks[1])


_UNSEEN = """
SELECT user_id, least(5, (SELECT count(DISTINCT p_brand) FROM part JOIN lineitem ON l_partkey = p_partkey) - count(*)) AS n"""


@query(
    f"""
SELECT * FROM ({_UNSEEN}, true AS none_rated, true AS titles_right FROM {_RATINGS} GROUP BY user_id) WHERE n > 0"""
)
def als_unseen_topn(spark, folder):
    """Every user's best items among those not rated: as many as there are, none rated, with the titles of the table."""
    rated = ratings(spark, folder)
    coded = als.code_ratings(rated)
    best = stage(als.recommend_unseen(als.fit(coded, rank=10, reg=0.01), coded), "best")
    again = best.join(coded.ratings, ["user_id", "item_id"], "left_semi").select("user_id", "item_id", F.lit(True).alias("again"))
    titles = brand_titles(spark, folder)
    named = best.join(again, ["user_id", "item_id"], "left").join(titles, "item_id", "left")
    texts = _title_checks(als.as_text_rows(best, titles), titles)
    per_user = named.groupBy("user_id").agg(F.count("*").alias("n"), (F.count("again") == 0).alias("none_rated"))
    return per_user.join(texts, "user_id").select("user_id", "n", "none_rated", "titles_right")


def _title_checks(texts, titles):
    """Whether every ``id:title`` of a user's text has the title of the table, or none where it has none."""
    entries = texts.select("user_id", F.explode(F.split("recommendations", ",(?=Brand#)")).alias("entry"))
    split = F.split("entry", ":", 2)
    entries = entries.select("user_id", F.get(split, F.lit(0)).alias("item_id"), F.get(split, F.lit(1)).alias("given"))
    right = F.col("given") == F.coalesce("title", F.lit(""))
    return entries.join(titles, "item_id", "left").groupBy("user_id").agg(
        F.every(right).alias("titles_right"), F.count("*").alias("entries")
    )


def _quantities(spark, folder):
    """A customer's whole quantity of a brand: busy customers buy more of every brand, which factors can learn."""
    return line_prefs(spark, folder).groupBy("user_id", "item_id").agg(F.sum("pref").alias("rating"))


_SPLIT = """
marked AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, p_brand AS item_id,
         md5(CAST(o_custkey AS VARCHAR) || '|' || p_brand || '|holdout') AS mark
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
split AS (
  SELECT user_id, item_id,
         mark[1:8] < '33333333' AND mark > min(mark) OVER (PARTITION BY user_id)
         AND mark > min(mark) OVER (PARTITION BY item_id) AS held
  FROM marked)"""


@query(f"WITH {_SPLIT} SELECT user_id, item_id, held FROM split")
def als_holdout_split(spark, folder):
    return als.split_holdout(_quantities(spark, folder)).select("user_id", "item_id", "held")


@query(f"WITH {_SPLIT} SELECT count(*) AS held, true AS finite, true AS below_mean, true AS ranked FROM split WHERE held")
def als_holdout(spark, folder):
    """Held-out ratings are predicted better than by the mean of the others."""
    found = als.evaluate_holdout(_quantities(spark, folder), rank=1, reg=0.2)
    ranked = F.lit(True)
    for metric in ("precision", "recall", "ndcg"):
        ranked &= (F.col(metric) > 0) & (F.col(metric) <= 1)
    return found.select(
        "held", (~F.isnan("mse")).alias("finite"), (F.col("mse") < F.col("mean_mse")).alias("below_mean"), ranked.alias("ranked")
    )


@query(
    """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, 5 AS entries, true AS titles_right
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""
)
def als_recommend_ranges(spark, folder):
    """Recommendations of all users in ranges: stopped after two, run again, every user there once."""
    coded = als.code_ratings(ratings(spark, folder))
    model = als.fit(coded, rank=10, reg=0.01)
    out, size = new_folder(spark, "ranges"), -(-coded.users.count() // 5)
    als.recommend_in_ranges(model, coded, out, users_per_range=size, most=2)
    rows = als.recommend_in_ranges(model, coded, out, users_per_range=size)
    titles = brand_titles(spark, folder)
    checked = _title_checks(als.as_text_rows(rows, titles), titles)
    return checked.select("user_id", F.col("entries").cast("int").alias("entries"), "titles_right")


@query(
    f"""
SELECT count(*) AS rated, count(DISTINCT user_id) * count(DISTINCT item_id) - count(*) AS unrated, true AS rated_higher
FROM {_RATINGS}"""
)
def als_implicit_order(spark, folder):
    """The implicit fit prefers, on average, what a user has rated to what not."""
    coded = als.code_ratings(ratings(spark, folder))
    model = als.fit(coded, rank=10, reg=0.01, implicit=True)
    every = als.recommend_all_users(model, coded, coded.items.count())
    marked = every.join(coded.ratings.select("user_id", "item_id", F.lit(True).alias("known")), ["user_id", "item_id"], "left")
    is_rated = F.col("known").isNotNull()
    higher = F.avg(F.when(is_rated, F.col("score"))) > F.avg(F.when(~is_rated, F.col("score")))
    return marked.agg(F.count_if(is_rated).alias("rated"), F.count_if(~is_rated).alias("unrated"), higher.alias("rated_higher"))
