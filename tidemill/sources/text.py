"""Readers and parsers for delimited text.

Two ways in: :func:`read_delimited` lets the csv reader do the typing while it scans, and
:func:`parse_fields` takes lines that are already a column (a stream's payload, or lines whose
bad rows have to be kept and counted).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemill import schemas
from tidemill.operators.rejects import REJECTS, accepted


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files as column ``line``; ``path`` may hold globs."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their place ``line_order`` among all lines of the files: file name, block of the file, place in the block.

    Values compare as the lines follow each other when the files are read by name; nothing is sorted for it. They
    say nothing about how many lines are between two.
    """
    lines = spark.read.text(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),  # ascends inside a block, which one task reads
    )
    return lines.select(F.col("value").alias("line"), place.alias("line_order"))


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = " "
) -> DataFrame:
    """Typed rows of a headerless delimited file; a malformed row fails the job.

    All fields of a row are tested, whichever columns are used. Quotes are ordinary characters. An empty field
    reads as NULL; a row of another number of fields is malformed, an empty line is left out.
    """
    lines = read_lines(spark, path).where("line <> ''")
    parts = F.split(F.col("line"), re.escape(sep), -1)
    sound = F.size(parts) == len(schema)
    fields = []
    for at, field in enumerate(schema):
        part = F.get(parts, F.lit(at))
        value = F.nullif(part, F.lit("")).try_cast(field.dataType)
        sound = sound & ((part == "") | value.isNotNull())
        fields.append(value.alias(field.name))
    message = F.concat(F.lit("MALFORMED row: "), F.col("line"))
    fails = F.when(sound, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return lines.where(fails).select(*fields)


def _field(parts: Column, index: int, field, trim: bool, strict: bool) -> Column:
    value = F.get(parts, F.lit(index))
    if trim:
        value = F.trim(value)
    if not isinstance(field.dataType, StringType):
        value = value.cast(field.dataType) if strict else value.try_cast(field.dataType)
    return value.alias(field.name)


def parse_fields(
    lines: DataFrame,
    schema: StructType,
    sep: str,
    positions: list[int] | None = None,
    column: str = "line",
    trim: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Split ``column`` at the literal ``sep`` and type the fields at ``positions``.

    Trailing empty fields are kept. A missing field is NULL; a field that does not cast is NULL,
    or fails the job when ``strict``. Other columns of ``lines`` pass through.
    """
    parts = F.split(F.col(column), re.escape(sep), -1)
    positions = positions if positions is not None else list(range(len(schema)))
    fields = [
        _field(parts, at, field, trim, strict) for at, field in zip(positions, schema, strict=True)
    ]
    return lines.select(*[c for c in lines.columns if c != column], *fields)


def split_rejects(
    lines: DataFrame, schema: StructType, sep: str, column: str = "line", **options
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows whose fields are all present and typed, and the lines of the others."""
    raw = F.col(column).alias("raw_line")
    parsed = parse_fields(lines.select("*", raw), schema, sep, column=column, **options)
    complete = F.lit(True)
    for field in schema:
        complete = complete & F.col(field.name).isNotNull()
    good = parsed.where(complete).drop("raw_line")
    bad = parsed.where(~complete).select("raw_line")
    return good, bad


def parse_house(lines: DataFrame, more_than: int = 20) -> DataFrame:
    """Rows with more than ``more_than`` fields, reduced to client, city, keyword and area.

    Empty fields at the end of a line do not count towards its length.
    """
    parts = F.split(F.rtrim(F.col("line"), F.lit(",")), ",", -1)
    return (
        lines.select(parts.alias("parts"))
        .where(F.size("parts") > more_than)
        .select(
            F.get("parts", F.lit(0)).alias("client"),
            F.get("parts", F.lit(1)).alias("city"),
            F.replace(F.get("parts", F.lit(2)), F.lit('"'), F.lit("")).alias("keyword"),
            F.get("parts", F.lit(15)).alias("area"),
        )
    )


def parse_access_log(lines: DataFrame) -> DataFrame:
    """Day, ip and cookie of ``|~|`` separated log lines (fields 0, 2 and 6 of 7)."""
    return parse_fields(lines, schemas.ACCESS_LOG, "|~|", positions=[0, 2, 6]).select(
        "*", F.substring("log_time", 1, 10).alias("day")
    )


def parse_timed_log(lines: DataFrame, observation: Observation | str = REJECTS) -> DataFrame:
    """:func:`parse_access_log` with the log time as ``ts``; lines without a readable time are counted and left out."""
    rows = parse_access_log(lines).withColumn("ts", F.col("log_time").try_cast("timestamp"))
    return accepted(rows, F.col("ts").isNotNull(), observation)


def parse_search(lines: DataFrame, observation: Observation | str = REJECTS) -> DataFrame:
    """``name item`` lines; lines without an item are counted and left out."""
    return accepted(parse_fields(lines, schemas.SEARCH, " "), F.col("item").isNotNull(), observation)


def parse_ratings(lines: DataFrame) -> DataFrame:
    """``user,movie,rating`` lines with blanks trimmed; rating -1 (not scored) counts as 3."""
    rows = parse_fields(lines, schemas.RATINGS, ",", trim=True, strict=True)
    return rows.withColumn("rating", clean_rating(F.col("rating")))


def clean_rating(rating: Column) -> Column:
    """-1 marks a movie watched but not scored; it takes the middle score 3."""
    return F.when(rating == -1, F.lit(3)).otherwise(rating).cast("double")


def parse_movies(lines: DataFrame, order: str | None = None) -> DataFrame:
    """``movie_id -> title`` of ``id,score,title`` lines with a non-empty id.

    Titles keep their commas. A repeated id keeps the title that is last by column ``order``, or
    the greatest title when lines carry no order of their own.
    """
    parts = F.split("line", ",", 3)
    rows = lines.where(F.get(parts, F.lit(0)) != "").select(
        F.get(parts, F.lit(0)).cast("int").alias("movie_id"),
        F.get(parts, F.lit(2)).alias("title"),
        (F.col(order) if order else F.lit(0)).alias("line_order"),
    )
    last = F.max(F.struct("line_order", "title"))
    return rows.groupBy("movie_id").agg(last["title"].alias("title"))
