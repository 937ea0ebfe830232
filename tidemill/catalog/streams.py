"""Streams, replayed from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemill import schemas
from tidemill.catalog.batch import click_messages
from tidemill.catalog.tables import registrar, table, text
from tidemill.functions.fields import clock_text
from tidemill.operators.rejects import accepted, counted_in_stream
from tidemill.operators.traffic import pv_ip_uv
from tidemill.plans.streams import clicks_per_user
from tidemill.session import new_folder, stage
from tidemill.sinks.keyed_table import KeyedTable
from tidemill.sinks.ledger import Ledger, file_place
from tidemill.sinks.batches import batch_writer, compact_totals, read_batches, read_totals
from tidemill.sources.streams import parse_clicks, replay_stream, text_stream
from tidemill.streaming.late import late_rows, read_late
from tidemill.streaming.run import run_to_end, start
from tidemill.streaming.totals import batch_report, running_totals
from tidemill.streaming.windows import hottest, item_windows, latest, traffic_windows, united, visitor_sketches

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)

# Events are minutes apart, so the windows here are hours long. A window is closed once an event
# an hour past its end has been seen.
DELAY = "1 hour"
_FORMAT = "'%Y-%m-%d %H:%M:%S'"


def events_stream(spark, folder):
    events = table(spark, folder, "events")
    # a pattern, since a stream takes a plain path for a folder: the table may be one file or a folder
    stream = replay_stream(spark, f"{folder}/events.parque[t]", events.schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def closed_windows(spark, folder, out, checkpoint, counts, *steps):
    """Replay the events in two deliveries and then a last event days later, which closes all windows.

    Its own windows stay open, so append output has every window of the events and none of its own.
    """
    inbox = new_folder(spark, "inbox")
    events = table(spark, folder, "events")
    middle = events.agg(F.percentile_approx(F.col("ts").cast("timestamp"), 0.5).alias("m")).first()["m"]
    late = F.col("ts").cast("timestamp") > F.lit(middle)
    last = events.orderBy(F.desc("ts")).limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 DAYS"))
    for delivery in (events.where(~late), events.where(late), last):
        delivery.write.mode("append").parquet(inbox)
        stream = replay_stream(spark, inbox, events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        run_to_end(counts(stream), checkpoint, batch_writer(out, *steps))
    return counts(table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))).schema


def _log(events):
    return events.select("ts", F.col("event_type").alias("ip"), text("user_id").alias("cookie_id"))


def _searches(events):
    return events.select("ts", text("user_id").alias("item"))


def _folders(spark, name):
    return new_folder(spark, name), new_folder(spark, f"{name}-checkpoint")


def _readable(counts, *columns):
    start, end = clock_text("window_start"), clock_text("window_end")
    return counts.select(start.alias("window_start"), end.alias("window_end"), *columns)


@query(
    """
SELECT count(*) AS pv, count(DISTINCT event_type) AS ips, count(DISTINCT user_id) AS uv
FROM events"""
)
def stream_pv_ip_uv_batch(spark, folder):
    """Report of each micro-batch; the table is one file, so there is one batch."""
    out, checkpoint = _folders(spark, "batch-report")
    run_to_end(_log(events_stream(spark, folder)), checkpoint, batch_writer(out, pv_ip_uv))
    return spark.read.parquet(out).select("pv", "ips", "uv")


@query("SELECT event_type AS ip, count(*) AS views FROM events GROUP BY 1")
def stream_batch_sql(spark, folder):
    """SQL of one's own over each micro-batch; totals over the batches."""
    out, checkpoint = _folders(spark, "batch-sql")
    report = batch_report("SELECT ip, count(*) AS views FROM access_log GROUP BY ip", "access_log")
    run_to_end(_log(events_stream(spark, folder)), checkpoint, batch_writer(out, report))
    return spark.read.parquet(out).groupBy("ip").agg(F.sum("views").alias("views"))


@query(
    f"""
SELECT strftime(window_start, {_FORMAT}) AS window_start, strftime(window_end, {_FORMAT}) AS window_end,
       pv, ips, uv
FROM (
  SELECT time_bucket(INTERVAL '6 hours', ts) AS window_start,
         window_start + INTERVAL '6 hours' AS window_end, count(*) AS pv,
         count(DISTINCT event_type) AS ips, count(DISTINCT user_id) AS uv
  FROM events GROUP BY 1
)"""
)
def stream_pv_uv_tumbling(spark, folder):
    out, checkpoint = _folders(spark, "traffic")
    schema = closed_windows(
        spark, folder, out, checkpoint, lambda events: traffic_windows(_log(events), "6 hours", DELAY)
    )
    return _readable(read_batches(spark, out, schema), "pv", "ips", "uv")


# Each event lies in three windows of a day that start 8 hours apart.
_SLIDING = """
sliding AS (
  SELECT window_start, window_start + INTERVAL '1 day' AS window_end, item, count(*) AS n
  FROM (
    SELECT time_bucket(INTERVAL '8 hours', ts) - k * INTERVAL '8 hours' AS window_start,
           CAST(user_id AS VARCHAR) AS item
    FROM events, (VALUES (0), (1), (2)) t(k))
  GROUP BY window_start, item)"""


@query(
    f"""WITH {_SLIDING}
SELECT strftime(window_start, {_FORMAT}) AS window_start, strftime(window_end, {_FORMAT}) AS window_end,
       item, n FROM sliding"""
)
def stream_sliding_count(spark, folder):
    """All windows, open ones included: update output, last count per window and item."""
    out, checkpoint = _folders(spark, "sliding")
    searches = _searches(events_stream(spark, folder))
    counts = item_windows(searches, window="1 day", slide="8 hours", delay=DELAY)
    run_to_end(counts, checkpoint, batch_writer(out), "update")
    rows = read_batches(spark, out, counts.schema)
    return _readable(latest(rows, ["window_start", "window_end", "item"], "n"), "item", "n")


@query(
    f"""WITH {_SLIDING}
SELECT strftime(window_start, {_FORMAT}) AS window_start, strftime(window_end, {_FORMAT}) AS window_end,
       item, n, rank
FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, item) AS INTEGER) AS rank
  FROM sliding)
WHERE rank <= 3"""
)
def stream_hot_topk(spark, folder):
    out, checkpoint = _folders(spark, "hottest")
    schema = closed_windows(
        spark, folder, out, checkpoint,
        lambda events: item_windows(_searches(events), window="1 day", slide="8 hours", delay=DELAY),
        hottest(3),
    )
    schema = StructType([*schema.fields, StructField("rank", IntegerType())])
    return _readable(read_batches(spark, out, schema), "item", "n", "rank")


_CLICK_SUMS = """
SELECT CAST(user_id AS VARCHAR) AS {0},
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total
FROM events GROUP BY 1"""


@query(_CLICK_SUMS.format("uid"))
def stream_running_totals(spark, folder):
    out, checkpoint = _folders(spark, "running")
    totals = running_totals(parse_clicks(click_messages(events_stream(spark, folder))))
    run_to_end(totals, checkpoint, batch_writer(out), "update")
    return latest(read_batches(spark, out, totals.schema), ["uid"], "total")


@query(_CLICK_SUMS.format("key"))
def sink_keyed_increment(spark, folder):
    """Totals from the increments, folded into one table before they are read."""
    out, checkpoint = _folders(spark, "clicks")
    messages = click_messages(events_stream(spark, folder))
    clicks_per_user(messages, out, checkpoint, every=None).awaitTermination()
    compact_totals(spark, out, schemas.COUNTS)
    return read_totals(spark, out, schemas.COUNTS)


@query(_CLICK_SUMS.format("key"))
def stream_resume(spark, folder):
    """The stream stops between two deliveries of files and goes on from its checkpoint."""
    out, checkpoint = _folders(spark, "resumed")
    inbox = new_folder(spark, "inbox")
    events = table(spark, folder, "events")
    early = F.col("event_type").isin("click", "view")
    for delivery in (events.where(early), events.where(~early)):
        delivery.write.mode("append").parquet(inbox)
        messages = click_messages(replay_stream(spark, inbox, events.schema))
        clicks_per_user(messages, out, checkpoint, every=None).awaitTermination()
    return read_totals(spark, out, schemas.COUNTS)


_TOO_LATE = "(event_type = 'error' AND ts < (SELECT max(ts) FROM events) - INTERVAL '10 days')"


@query(
    f"""
SELECT 'window' AS kind, strftime(time_bucket(INTERVAL '6 hours', ts), {_FORMAT}) AS name, count(*) AS n
FROM events WHERE NOT {_TOO_LATE} GROUP BY 2
UNION ALL
SELECT 'late', 'rows', count(*) FROM events WHERE {_TOO_LATE}"""
)
def stream_late_rows(spark, folder):
    """Old errors are delivered when their windows have long been closed: counted as late, not in the windows."""
    (out, checkpoint), late = _folders(spark, "late"), new_folder(spark, "late-rows")
    inbox = new_folder(spark, "inbox")
    events = table(spark, folder, "events")
    last = events.agg(F.max("ts").alias("m")).first()["m"]
    held = (F.col("event_type") == "error") & (F.col("ts") < F.lit(last) - F.expr("INTERVAL 10 DAYS"))
    closing = events.orderBy(F.desc("ts")).limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 DAYS"))
    for delivery in (events.where(~held), events.where(held), closing):
        delivery.write.mode("append").parquet(inbox)
        stream = replay_stream(spark, inbox, events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        # every event is a group of its own, so the rows that the state drops are events
        rows = stream.select("ts", text("event_id").alias("item"))
        counts = item_windows(rows, window="6 hours", slide="6 hours", delay=DELAY)
        with late_rows(spark, late, "late") as listener:
            running = start(counts, checkpoint, batch_writer(out), name="late")
            running.awaitTermination()
            listener.finish(running)
    windows = read_batches(spark, out, counts.schema).groupBy("window_start").agg(F.sum("n").alias("n"))
    dropped = read_late(spark, late).agg(F.sum("late_rows").alias("n"))
    return windows.select(F.lit("window").alias("kind"), clock_text("window_start").alias("name"), "n").unionByName(
        dropped.select(F.lit("late").alias("kind"), F.lit("rows").alias("name"), "n")
    )


@query(
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS pv, true AS near FROM events GROUP BY 1"""
)
def stream_uv_sketch(spark, folder):
    """Visitors per day from the stored sketches of six hours each, within 3 % of the exact number."""
    out, checkpoint = _folders(spark, "sketches")
    schema = closed_windows(
        spark, folder, out, checkpoint, lambda events: visitor_sketches(_log(events), "6 hours", DELAY)
    )
    days = united(read_batches(spark, out, schema), F.date_format("window_start", "yyyy-MM-dd"))
    events = table(spark, folder, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("period"), "user_id")
    exact = events.groupBy("period").agg(F.countDistinct("user_id").alias("exact"))
    near = F.abs(F.col("uv") - F.col("exact")) <= 0.03 * F.col("exact")
    return days.join(exact, "period").select(F.col("period").alias("day"), "pv", near.alias("near"))


@query(_CLICK_SUMS.format("key"))
def sink_keyed_table(spark, folder):
    """Totals in versioned buckets; the second delivery is handed over twice."""
    out = new_folder(spark, "keyed-table")
    clicks = parse_clicks(click_messages(table(spark, folder, "events"))).where("valid")
    rows = stage(clicks.select(F.col("uid").alias("key"), F.col("click_count").alias("total")), "clicks")
    part = F.pmod(F.xxhash64("key", "total"), F.lit(4))
    keyed = KeyedTable(spark, out)
    for batch in (0, 1, 1, 2, 3):
        keyed.add(rows.where(part == batch), batch)
    return keyed.read()


@query(_CLICK_SUMS.format("key"))
def stream_offset_ledger(spark, folder):
    """The checkpoint is lost after the first delivery; the ledger tells the new one what has been read."""
    out, inbox = new_folder(spark, "ledger"), new_folder(spark, "inbox")
    events = table(spark, folder, "events")
    early = F.col("event_type").isin("click", "view")
    for delivery in (events.where(early), events.where(~early)):
        click_messages(delivery).select("value").write.mode("append").text(inbox)
        checkpoint = new_folder(spark, "ledger-checkpoint")
        ledger = Ledger(spark, out, checkpoint)
        messages = ledger.unread(file_place(text_stream(spark, inbox)))
        clicks = parse_clicks(messages, keep=["source", "position"])
        writer = ledger.writer("uid", "click_count")
        run_to_end(clicks, checkpoint, writer)
    return ledger.totals()


@query(
    """
SELECT 'accepted' AS outcome, count(*) FILTER (event_type <> 'error') AS n FROM events
UNION ALL SELECT 'rejected', count(*) FILTER (event_type = 'error') FROM events"""
)
def click_rejects(spark, folder):
    """Broken click messages, counted by the stream itself while it adds up the others."""
    out, checkpoint = _folders(spark, "click-rejects")
    broken = F.when(F.col("event_type") == "error", F.lit('{"uid":')).otherwise(F.col("value"))
    events = events_stream(spark, folder)
    messages = click_messages(events, keep=["event_type"]).select(broken.alias("value"))
    clicks = accepted(parse_clicks(messages), F.col("valid"))
    running = start(clicks, checkpoint, batch_writer(out))
    running.awaitTermination()
    counts = counted_in_stream(running)
    return spark.createDataFrame(sorted(counts.items()), "outcome string, n bigint")


@query(
    """
SELECT CAST(CASE WHEN event_type IN ('click', 'view') THEN 0 WHEN event_type = 'error' THEN 1 ELSE 2 END AS BIGINT) AS batch_id,
       count(*) AS pv, count(DISTINCT event_type) AS ips, count(DISTINCT user_id) AS uv
FROM events GROUP BY 1"""
)
def stream_report_batches(spark, folder):
    """A report of each of three micro-batches: one delivery each, whatever its event times."""
    (out, checkpoint), inbox = _folders(spark, "reports"), new_folder(spark, "inbox")
    events = table(spark, folder, "events")
    first, second = F.col("event_type").isin("click", "view"), F.col("event_type") == "error"
    for delivery in (events.where(first), events.where(second), events.where(~first & ~second)):
        delivery.write.mode("append").parquet(inbox)
        run_to_end(_log(replay_stream(spark, inbox, events.schema)), checkpoint, batch_writer(out, pv_ip_uv))
    schema = pv_ip_uv(_log(events)).schema
    return read_batches(spark, out, schema).select("batch_id", "pv", "ips", "uv")
