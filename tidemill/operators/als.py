"""Matrix factorization recommendations with Spark ML's ALS.

Ratings are ``(user_id, item_id, rating)`` with keys of any type; the solver wants integer codes,
which come from :mod:`tidemill.functions.ids`.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.evaluation import RankingEvaluator, RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemill.functions.fields import ranked_titles
from tidemill.functions.ids import dense_ids, encode
from tidemill.operators import few_items
from tidemill.operators.skew import (
    ROWS_PER_SLICE,
    fits_broadcast,
    heavy_in_table,
    lookup,
    skewed_join,
    sliced_join,
)
from tidemill.session import shared_root, stage

# Default settings and search grid of the recommender: fixed values.
RANK = 50
ITERATIONS = 10
REGULARIZATION = 0.0001
TOP = 5
BLOCKS = 16
# Iterations whose shuffled factors may be on disk at once: a checkpoint lets those before it go.
CHECKPOINT_EVERY = 2
# A side of few keys gets fewer blocks than that, one of very many more.
LEAST_KEYS_PER_BLOCK, MOST_KEYS_PER_BLOCK = 8, 100_000
GRID_RANKS = (10, 50)
GRID_REGULARIZATIONS = (1.0, 0.01, 0.0001)
GRID_ALPHAS = (1.0, 40.0)

GRID_SCHEMA = StructType(
    [
        StructField("mode", StringType()),
        StructField("rank", IntegerType()),
        StructField("reg", DoubleType()),
        StructField("alpha", DoubleType()),
        StructField("mse", DoubleType()),
    ]
)


@dataclass(frozen=True)
class CodedRatings:
    """Ratings with integer codes, and the two tables of codes."""

    ratings: DataFrame
    users: DataFrame
    items: DataFrame


def code_ratings(ratings: DataFrame) -> CodedRatings:
    """Number users and items; all three tables are staged, since every fit reads them again."""
    source = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"))
    source = stage(source.dropna(), "ratings")
    users = stage(dense_ids(source, "user_id", "user_code"), "user-codes")
    items = stage(dense_ids(source, "item_id", "item_code"), "item-codes")
    popular = heavy_in_table(source, "item_id", ROWS_PER_SLICE)
    coded = sliced_join(encode(source, users, "user_id"), items, "item_id", popular).select(
        "user_id",
        "item_id",
        F.col("user_code").cast("int").alias("user_code"),
        F.col("item_code").cast("int").alias("item_code"),
        "rating",
    )
    return CodedRatings(stage(coded, "coded-ratings"), users, items)


def block_count(keys: int) -> int:
    """Blocks of a side of the ratings with that many users or items.

    A user's factors are sent once to every block with an item of the user, in every iteration. With few items that
    is all blocks, so they get few of them.
    """
    if keys < BLOCKS * LEAST_KEYS_PER_BLOCK:
        return max(1, math.ceil(keys / LEAST_KEYS_PER_BLOCK))
    return max(BLOCKS, math.ceil(keys / MOST_KEYS_PER_BLOCK))


def fit(
    coded: CodedRatings,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    reg: float = REGULARIZATION,
    implicit: bool = False,
    alpha: float = 1.0,
    seed: int = 7,
    blocks: int | None = None,
) -> ALSModel:
    """Fit a factor model, explicit or implicit.

    ``blocks`` is the number of user and of item blocks. It seeds the factors, so the default comes from the number of
    users and of items (:func:`block_count`) and not from the cluster. The solver cuts its lineage every few
    iterations through the context's checkpoint folder.
    """
    spark = coded.ratings.sparkSession
    shared_root(spark)
    solver = ALS(
        userCol="user_code",
        itemCol="item_code",
        ratingCol="rating",
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        implicitPrefs=implicit,
        alpha=alpha,
        seed=seed,
        numUserBlocks=blocks or block_count(coded.users.count()),
        numItemBlocks=blocks or block_count(coded.items.count()),
        checkpointInterval=CHECKPOINT_EVERY,
        coldStartStrategy="drop",
    )
    return solver.fit(coded.ratings.select("user_code", "item_code", "rating"))


def predict_known(model: ALSModel, coded: CodedRatings) -> DataFrame:
    """Every rating next to its prediction."""
    return model.transform(coded.ratings).select("user_id", "item_id", "rating", "prediction")


def mean_squared_error(predictions: DataFrame) -> float:
    evaluator = RegressionEvaluator(
        metricName="mse", labelCol="rating", predictionCol="prediction"
    )
    return evaluator.evaluate(predictions)


def grid(
    coded: CodedRatings,
    ranks=GRID_RANKS,
    regs=GRID_REGULARIZATIONS,
    alphas=GRID_ALPHAS,
    iterations: int = ITERATIONS,
    parallelism: int = 4,
) -> DataFrame:
    """Error on the known ratings for each setting, explicit and implicit.

    The implicit rows compare preferences near 0 and 1 with raw ratings, so they rank settings
    among themselves only. With few items all settings are fitted in the same passes (:mod:`few_items`); with more,
    ``parallelism`` fits run side by side.
    """
    spark = coded.ratings.sparkSession
    settings = [few_items.Setting("explicit", rank, reg, None) for rank, reg in product(ranks, regs)]
    settings += [few_items.Setting("implicit", *rest) for rest in product(ranks, regs, alphas)]
    items = coded.items.count()
    if items <= few_items.MOST_ITEMS and coded.ratings.take(1):
        errors = few_items.mean_squared_errors(coded.ratings, items, settings, iterations)
        rows = [(*setting, error) for setting, error in zip(settings, errors, strict=True)]
        return spark.createDataFrame(rows, GRID_SCHEMA)

    @inheritable_thread_target(spark)
    def error(setting):
        mode, rank, reg, alpha = setting
        implicit = mode == "implicit"
        model = fit(coded, rank, iterations, reg, implicit=implicit, alpha=alpha or 1.0)
        return (*setting, mean_squared_error(predict_known(model, coded)))

    with ThreadPoolExecutor(parallelism) as pool:
        return spark.createDataFrame(list(pool.map(error, settings)), GRID_SCHEMA)


def _ranked(recommendations: DataFrame, coded: CodedRatings) -> DataFrame:
    """Solver output as rows ``(user_id, rank, item_id, score)``."""
    # One row per user on both sides, so no user code is heavy.
    rows = recommendations.join(coded.users, "user_code").select(
        "user_id", F.posexplode("recommendations").alias("_at", "_rec")
    )
    scored = rows.select(
        "user_id",
        (F.col("_at") + 1).alias("rank"),
        F.col("_rec.item_code").alias("item_code"),
        F.col("_rec.rating").cast("double").alias("score"),
    )
    return lookup(scored, coded.items, "item_code", "inner", costly=True).drop("item_code")


def recommend_all_users(model: ALSModel, coded: CodedRatings, n: int = TOP) -> DataFrame:
    """The ``n`` best items of every user; items the user has rated may be among them."""
    return _ranked(model.recommendForAllUsers(n), coded)


def recommend_some_users(
    model: ALSModel, coded: CodedRatings, wanted: DataFrame, n: int = TOP
) -> DataFrame:
    """As :func:`recommend_all_users` for the ``user_id`` of ``wanted``; unknown users give nothing."""
    codes = coded.users.join(wanted.select("user_id").distinct(), "user_id", "left_semi").select(
        F.col("user_code").cast("int").alias("user_code")
    )
    return _ranked(model.recommendForUserSubset(codes, n), coded)


def recommend_unseen(
    model: ALSModel, coded: CodedRatings, n: int = TOP, wanted: DataFrame | None = None
) -> DataFrame:
    """The ``n`` best items that each user (or each ``user_id`` of ``wanted``) has not rated, fewer where fewer are left.

    The solver cannot leave items out, so more are asked for: users are put into classes by how many items they have
    rated, each class twice as wide as the one before, and a class is asked for ``n`` more than its bound. A user with few
    ratings so costs few surplus rows, whatever the busiest user has rated.
    """
    seen = stage(coded.ratings.select("user_code", "item_code").distinct(), "seen")
    counts = seen.groupBy("user_code").agg(F.count("*").alias("held"))
    if wanted is not None:
        codes = coded.users.join(wanted.select("user_id").distinct(), "user_id", "left_semi")
        counts = counts.join(codes.select("user_code"), "user_code", "left_semi")
    tiers = stage(counts.select("user_code", F.ceil(F.log2("held")).cast("int").alias("tier")), "tiers")
    items = coded.items.count()
    found = None
    for row in sorted(tiers.select("tier").distinct().collect()):  # a row for each doubling
        users = tiers.where(F.col("tier") == row["tier"]).select("user_code")
        asked = model.recommendForUserSubset(users, min(items, n + 2 ** row["tier"]))
        found = asked if found is None else found.unionByName(asked)
    if found is None:
        found = model.recommendForUserSubset(tiers.select("user_code"), n)
    rows = found.select("user_code", F.inline("recommendations")).join(seen, ["user_code", "item_code"], "left_anti")
    order = Window.partitionBy("user_code").orderBy(F.desc("rating"), "item_code")
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    best = stage(best.select("user_code", "rank", "item_code", F.col("rating").cast("double").alias("score")), "unseen")
    named = lookup(best, coded.items, "item_code", "inner").join(coded.users, "user_code")
    return named.select("user_id", "rank", "item_id", "score")


# Hash digits that decide whether a rating is held out.
_SHARE_DIGITS = 8


def split_holdout(ratings: DataFrame, share: float = 0.2, seed: str = "holdout") -> DataFrame:
    """``user_id, item_id, rating, held``: about ``share`` of the user-item cells are held out for testing.

    A cell's place is the md5 of its keys and the seed, so the split is the same on every run and all ratings of a
    cell go one way. The cell with the least hash of every user and of every item stays in training, so that
    nothing is tested that the model has never seen. Ratings with a missing field are left out.
    """
    rows = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("rating")).dropna()
    key = F.concat_ws("|", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.lit(seed))
    rows = stage(rows.withColumn("_mark", F.md5(key.cast("binary"))), "marked")
    firsts = [rows.groupBy(side).agg(F.min("_mark").alias("_mark")).select("_mark") for side in ("user_id", "item_id")]
    kept = firsts[0].union(firsts[1]).distinct().withColumn("_first", F.lit(True))
    edge = f"{min(int(share * 16**_SHARE_DIGITS), 16**_SHARE_DIGITS - 1):0{_SHARE_DIGITS}x}"
    drawn = F.substring("_mark", 1, _SHARE_DIGITS) < edge
    return rows.join(kept, "_mark", "left").select(
        "user_id", "item_id", "rating", (drawn & F.col("_first").isNull()).alias("held")
    )


def evaluate_holdout(ratings: DataFrame, n: int = TOP, share: float = 0.2, seed: str = "holdout", **settings) -> DataFrame:
    """One row of errors and ranking metrics of a model fitted without the held-out ratings.

    ``mse`` is the error on them, ``mean_mse`` that of the training ratings' mean. ``precision``, ``recall`` and ``ndcg`` compare
    the ``n`` best items a user has not rated in training with the held-out ones, over users that have some.
    """
    split = stage(split_holdout(ratings, share, seed), "split")
    coded = code_ratings(split.where("not held").drop("held"))
    model = fit(coded, **settings)
    held = encode(stage(split.where("held"), "held"), coded.users, "user_id")
    held = lookup(held, coded.items, "item_id", "inner", costly=True)
    held = held.withColumns({c: F.col(c).cast("int") for c in ("user_code", "item_code")})
    held = stage(model.transform(held).select("user_id", "item_code", "rating", "prediction"), "tested")
    mean = coded.ratings.agg(F.avg("rating")).first()[0]
    error = held.agg(
        F.count("*").alias("held"),
        F.avg(F.pow(F.col("rating") - F.col("prediction"), F.lit(2))).alias("mse"),
        F.avg(F.pow(F.col("rating") - F.lit(mean), F.lit(2))).alias("mean_mse"),
    )
    best = lookup(recommend_unseen(model, coded, n, held), coded.items, "item_id", "inner", costly=True)
    code = F.col("item_code").cast("double")
    lists = best.groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", code.alias("code")))), lambda x: x["code"]).alias("prediction")
    )
    truth = held.groupBy("user_id").agg(F.collect_set(code).alias("label"))
    both = stage(truth.join(lists, "user_id"), "rankings")
    ranking = {
        name: RankingEvaluator(predictionCol="prediction", labelCol="label", metricName=metric, k=n).evaluate(both)
        for name, metric in (("precision", "precisionAtK"), ("recall", "recallAtK"), ("ndcg", "ndcgAtK"))
    }
    return error.withColumns({name: F.lit(value) for name, value in ranking.items()})


RANGE_DONE = StructType(
    [StructField(c, LongType()) for c in ("range", "first", "last", "top", "rows")]
)


def recommend_in_ranges(
    model: ALSModel,
    coded: CodedRatings,
    folder: str,
    n: int = TOP,
    users_per_range: int = 1_000_000,
    most: int | None = None,
) -> DataFrame:
    """As :func:`recommend_all_users`, range by range of user codes, with what is done kept in ``folder``.

    A range is written and then entered in the manifest; a run that stopped goes on with the ranges that are not
    there, at most ``most`` of them. Returns the rows of the ranges done so far. A manifest of other ranges or another ``n``
    is refused, and so the folder belongs to one model.
    """
    spark = coded.ratings.sparkSession
    users = coded.users.count()
    done = {row["range"]: row for row in _ranges_done(spark, folder).collect()}  # a row per range
    left = [at for at in range(-(-users // users_per_range)) if at not in done]
    for at in range(-(-users // users_per_range)):
        first, last = at * users_per_range, min(users, (at + 1) * users_per_range) - 1
        if at in done:
            if (done[at]["first"], done[at]["last"], done[at]["top"]) != (first, last, n):
                raise ValueError(f"{folder} holds recommendations of other ranges or another number")
            continue
        if most is not None and left.index(at) >= most:
            continue
        codes = coded.users.where(F.col("user_code").between(first, last)).select(F.col("user_code").cast("int").alias("user_code"))
        path = f"{folder}/rows/at={at}"
        _ranked(model.recommendForUserSubset(codes, n), coded).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path).count()
        entry = spark.createDataFrame([(at, first, last, n, rows)], RANGE_DONE)
        entry.coalesce(1).write.mode("overwrite").parquet(f"{folder}/done/at={at}")  # one file: there or not
    paths = [f"{folder}/rows/at={row['range']}" for row in _ranges_done(spark, folder).collect()]
    return spark.read.parquet(*paths) if paths else _ranked(model.recommendForAllUsers(n), coded).limit(0)


def _ranges_done(spark, folder: str) -> DataFrame:
    try:
        return spark.read.schema(RANGE_DONE).parquet(f"{folder}/done")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RANGE_DONE)


def history_of(ratings: DataFrame, wanted: DataFrame) -> DataFrame:
    """Distinct items rated by the ``user_id`` of ``wanted``.

    Few wanted users filter the rows where they are read. Many meet them after the rows have been reduced to one per user
    and item, which are stored, since a join that looks for busy users reads them twice.
    """
    pairs = ratings.select("user_id", "item_id")
    users = wanted.select("user_id").distinct()
    if fits_broadcast(users):
        return pairs.join(F.broadcast(users), "user_id", "left_semi").distinct()
    return skewed_join(stage(pairs.distinct(), "pairs"), users, "user_id")


def titles_in(titles: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of a title table whose ``item_id`` occurs in ``items``."""
    return titles.join(items.select("item_id").distinct(), "item_id", "left_semi")


def compare_with_history(
    recommended: DataFrame, coded: CodedRatings, wanted: DataFrame, titles: DataFrame
) -> DataFrame:
    """Titles a user has rated (``seen``) next to the recommended ones, for the wanted users."""
    seen = history_of(coded.ratings, wanted).select("user_id", F.lit("seen").alias("kind"), "item_id")
    fresh = recommended.select("user_id", F.lit("recommended").alias("kind"), "item_id")
    return lookup(seen.unionByName(fresh), titles, "item_id", "inner", costly=True).select(
        "user_id", "kind", "item_id", "title"
    )


def as_text_rows(recommended: DataFrame, titles: DataFrame) -> DataFrame:
    """One row per user with its recommendations as ``id:title,id:title``."""
    wanted = recommended.select("user_id", "rank", "item_id")
    named = lookup(wanted, titles, "item_id", "left", costly=True)
    return named.groupBy("user_id").agg(
        ranked_titles("rank", "item_id", "title").alias("recommendations")
    )


def save(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> ALSModel:
    return ALSModel.load(path)
