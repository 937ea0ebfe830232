"""The jobs of the command line: what they read, and where their results go."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.plans import item_cf, movies, reports, streams
from tidemill.session import scratch
from tidemill.sources.streams import kafka_stream, socket_stream, text_stream

SHOWN = 50
#: Trigger intervals of the original streams: fixed values.
TRAFFIC_EVERY, HOTTEST_EVERY, CLICKS_EVERY, LEDGER_EVERY = "60 seconds", "5 seconds", "10 seconds", "5 seconds"


@dataclass(frozen=True)
class Batch:
    """Named results of input paths: shown, or written whole below a folder."""

    run: Callable[..., dict[str, DataFrame]]
    paths: tuple[str, ...]
    more: str = ""  # arguments that may follow


@dataclass(frozen=True)
class Stream:
    """A query over messages, into an output folder."""

    start: Callable[..., StreamingQuery]
    every: str


def movie_profile(spark, ratings_path, movies_path):
    ratings, titles = movies.load_movies(spark, ratings_path, movies_path)
    return {**movies.profile(ratings), "titles": titles}


def movie_grid(spark, ratings_path, movies_path):
    ratings, _ = movies.load_movies(spark, ratings_path, movies_path)
    return {"errors": movies.evaluate(ratings)}


def movie_recommendations(spark, ratings_path, movies_path, base):
    ratings, titles = movies.load_movies(spark, ratings_path, movies_path)
    return {"recommendations": movies.recommend(ratings, titles, base)}


def movie_check(spark, ratings_path, movies_path, *users):
    """What the named users have watched next to what they are recommended."""
    ratings, titles = movies.load_movies(spark, ratings_path, movies_path)
    wanted = spark.createDataFrame([(u,) for u in users], "user_id string")
    return {"watched_and_recommended": movies.check(ratings, titles, wanted).orderBy("user_id", "kind", "item_id")}


def movie_holdout(spark, ratings_path, movies_path):
    ratings, _ = movies.load_movies(spark, ratings_path, movies_path)
    return {"held_out": movies.evaluate_held_out(ratings)}


BATCHES = {
    "people": Batch(reports.people_from_text, ("PEOPLE",)),
    "purchases": Batch(reports.purchases_from_text, ("USERS", "PURCHASES")),
    "houses": Batch(reports.houses_from_text, ("HOUSES",)),
    "item-cf": Batch(item_cf.item_cf_from_text, ("PREFERENCES",)),
    "movie-profile": Batch(movie_profile, ("RATINGS", "MOVIES")),
    "movie-grid": Batch(movie_grid, ("RATINGS", "MOVIES")),
    "movie-holdout": Batch(movie_holdout, ("RATINGS", "MOVIES")),
    "movie-check": Batch(movie_check, ("RATINGS", "MOVIES"), "USER..."),
    "movie-recommendations": Batch(movie_recommendations, ("RATINGS", "MOVIES", "BASE")),
}
STREAMS = {
    "traffic-batches": Stream(streams.traffic_per_batch, TRAFFIC_EVERY),
    "traffic-windows": Stream(streams.traffic_per_window, TRAFFIC_EVERY),
    "hottest-searches": Stream(streams.hottest_searches, HOTTEST_EVERY),
    "clicks": Stream(streams.clicks_per_user, CLICKS_EVERY),
    "clicks-ledger": Stream(streams.clicks_with_ledger, LEDGER_EVERY),
}


def usage() -> str:
    lines = ["usage: python -m tidemill JOB ARGUMENTS [--out FOLDER] [--once]", "", "Batch jobs (results are shown, or written below --out):"]
    lines += [f"  {name} {' '.join(job.paths)} {job.more}".rstrip() for name, job in BATCHES.items()]
    lines += ["", "Streams (SOURCE: a folder of text files, kafka://HOST:PORT/TOPIC or socket://HOST:PORT; --once stops at the end):"]
    lines += [f"  {name} SOURCE OUT CHECKPOINT" for name in STREAMS]
    return "\n".join(lines)


def messages(spark: SparkSession, source: str) -> DataFrame:
    """A stream of lines in column ``value`` with their ``timestamp``."""
    place = urlparse(source)
    if place.scheme == "kafka":
        return kafka_stream(spark, [place.netloc], [place.path.strip("/")])
    if place.scheme == "socket":
        return socket_stream(spark, place.hostname, place.port or 9999)
    return text_stream(spark, source)


def run_batch(spark: SparkSession, name: str, arguments: list[str], out: str | None) -> None:
    """Run a batch job; its intermediate tables go when it is done."""
    with scratch(spark):
        for label, result in BATCHES[name].run(spark, *arguments).items():
            if out:
                result.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{label}")
            else:
                print(label)
                result.show(SHOWN, truncate=False)


def start_stream(spark: SparkSession, name: str, arguments: list[str], once: bool) -> StreamingQuery:
    source, out, checkpoint = arguments
    job = STREAMS[name]
    return job.start(messages(spark, source), out, checkpoint, every=None if once else job.every)
