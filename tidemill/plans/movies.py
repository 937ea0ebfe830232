"""Movie recommendations by matrix factorization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.ids import dense_ids
from tidemill.operators import als
from tidemill.operators.traffic import column_stats
from tidemill.sinks.text import write_sorted_text
from tidemill.sources.text import parse_movies, parse_ratings, read_lines, read_ordered_lines


def load_movies(spark: SparkSession, ratings_path: str, movies_path: str) -> tuple[DataFrame, DataFrame]:
    """Ratings ``(user_id, item_id, rating)`` and titles ``(item_id, title)``."""
    ratings = parse_ratings(read_lines(spark, ratings_path)).withColumnRenamed("movie_id", "item_id")
    lines = read_ordered_lines(spark, movies_path)  # of two lines with the same id the last one counts
    titles = parse_movies(lines, order="line_order").withColumnRenamed("movie_id", "item_id")
    return ratings, titles


def profile(ratings: DataFrame) -> dict[str, DataFrame]:
    """Statistics of the user codes and of the item ids."""
    items = ratings.select(F.col("item_id").cast("double").alias("item_id")).distinct()
    return {
        "users": column_stats(dense_ids(ratings, "user_id"), "code"),
        "items": column_stats(items, "item_id"),
    }


def check(ratings: DataFrame, titles: DataFrame, wanted: DataFrame, **settings) -> DataFrame:
    """Fit, then show what the wanted users have watched next to what they are recommended."""
    coded = als.code_ratings(ratings)
    model = als.fit(coded, **settings)
    recommended = als.recommend_some_users(model, coded, wanted)
    return als.compare_with_history(recommended, coded, wanted, titles)


def evaluate(ratings: DataFrame) -> DataFrame:
    """Errors over the whole grid of settings."""
    return als.grid(als.code_ratings(ratings))


def evaluate_held_out(ratings: DataFrame, **settings) -> DataFrame:
    """Errors and ranking metrics on ratings that the fit has not seen."""
    return als.evaluate_holdout(ratings, **settings)


def recommend(ratings: DataFrame, titles: DataFrame, base: str, **settings) -> DataFrame:
    """Fit, save the model, write every user's recommendations as sorted text, and return them."""
    coded = als.code_ratings(ratings)
    model = als.fit(coded, **settings)
    als.save(model, f"{base}/model")
    rows = als.as_text_rows(als.recommend_all_users(model, coded), titles)
    line = F.concat_ws(",", "user_id", "recommendations")
    write_sorted_text(rows, f"{base}/result", ["user_id"], line)
    return rows
