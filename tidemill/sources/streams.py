"""Stream sources. Every one gives a column ``value`` (text) except table replay."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill import schemas

_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)


def kafka_options(
    servers: list[str],
    topics: list[str],
    starting: str | dict[str, dict[int, int]] = "earliest",
    max_offsets_per_trigger: int | None = None,
    group: str | None = None,
) -> dict[str, str]:
    """Options of a Kafka source.

    ``starting`` is ``earliest``, ``latest`` or offsets per topic and partition; it only matters
    for the first start, later ones go on from the query's checkpoint.
    """
    options = {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": ",".join(sorted(set(topics))),
        "startingOffsets": starting if isinstance(starting, str) else json.dumps(starting),
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: list[str], topics: list[str], **options) -> DataFrame:
    """Topic, text, time and place of Kafka messages. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options))
    value = F.col("value").cast("string").alias("value")
    return reader.load().select("topic", value, "timestamp", "partition", "offset")


def socket_stream(spark: SparkSession, host: str, port: int = 9999) -> DataFrame:
    """Lines from a socket, for trying things out: a socket cannot be replayed after a failure."""
    return (
        spark.readStream.format("socket")
        .option("host", host)
        .option("port", port)
        .option("includeTimestamp", "true")
        .load()
    )


def text_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files that appear in ``folder``, with the time their file was last written as ``timestamp``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    written = F.col("_metadata.file_modification_time").alias("timestamp")
    return reader.load(folder).select("value", written)


def replay_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of ``folder`` (or one file) that match ``pattern``, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def parse_clicks(messages: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Click events of JSON messages, with ``valid`` telling whether uid and count are there.

    Broken JSON, a missing key, a count that is no number or fits no bigint makes a row invalid, not the
    batch. Counts are read as text, so large ones keep all digits; fractions are cut off. A time outside the years 1
    to 9999 reads as NULL. Columns named in ``keep`` pass through.
    """
    keep = keep or []
    # Taking the fields with inline reads each message once, however often they are used below.
    count = F.col("click_count").try_cast("decimal(38,6)").try_cast("bigint")
    millis = F.col("event_time").try_cast("bigint")
    click = F.inline(F.array(F.from_json(column, schemas.CLICK_JSON)))
    return messages.select(F.col(column).alias("raw"), *keep, click).select(
        "raw",
        *keep,
        "uid",
        F.timestamp_millis(F.when(millis.between(*_MILLIS), millis)).alias("event_time"),
        "os_type",
        count.alias("click_count"),
        (F.col("uid").isNotNull() & count.isNotNull()).alias("valid"),
    )
