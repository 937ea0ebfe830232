import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_sources import LOG, log_line
from tidemill import schemas
from tidemill.plans import streams as jobs
from tidemill.operators.rejects import accepted, counted_in_stream
from tidemill.sinks import batches
from tidemill.sinks.ledger import Ledger, file_place, kafka_place
from tidemill.sources.streams import parse_clicks, replay_stream, text_stream
from tidemill.streaming.late import late_rows, read_late
from tidemill.streaming.run import run_to_end, start, to_console
from tidemill.streaming.totals import running_totals
from tidemill.streaming.windows import hottest, item_windows, latest, traffic_windows, united, visitor_sketches

DAY = datetime(2024, 1, 1)


class Inbox:
    """Folder that takes one text file per batch."""

    def __init__(self, path):
        self.path, self.n = path, 0
        path.mkdir()

    def deliver(self, *lines):
        file = self.path / f"{self.n:03d}.txt"
        file.write_text("".join(f"{line}\n" for line in lines))
        os.utime(file, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path / "in")


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "checkpoint")


def messages(spark, inbox):
    return text_stream(spark, str(inbox.path), files_per_batch=1)


def timed(spark, inbox):
    """Lines ``seconds item`` as a stream with times on one day."""
    parts = F.split("value", " ")
    time = F.timestamp_seconds(F.lit(int(DAY.timestamp())) + parts[0].cast("bigint"))
    return messages(spark, inbox).select(time.alias("ts"), F.get(parts, F.lit(1)).alias("item"))


def seconds(t):
    return int((t - DAY).total_seconds())


def click(uid, count):
    return json.dumps({"uid": uid, "event_time": "0", "os_type": "Android", "click_count": count})


def test_traffic_per_window(spark, inbox, folders):
    inbox.deliver(*LOG)
    inbox.deliver(log_line("15:10:00", "10.0.0.9", "c9"))
    jobs.traffic_per_window(messages(spark, inbox), *folders, every=None).awaitTermination()
    found = spark.read.parquet(folders[0]).orderBy("window_start").collect()
    assert [(r.window_start.strftime("%H:%M"), r.pv, r.ips, r.uv) for r in found] == [
        ("14:59", 3, 2, 3),
        ("15:00", 3, 1, 2),
    ]


def test_traffic_per_batch(spark, inbox, folders):
    inbox.deliver(*LOG)
    inbox.deliver(LOG[0], LOG[0])
    jobs.traffic_per_batch(messages(spark, inbox), *folders, every=None).awaitTermination()
    found = spark.read.parquet(folders[0]).orderBy("batch_id").collect()
    assert [(r.pv, r.ips, r.uv) for r in found] == [(6, 2, 5), (2, 1, 1)]
    assert len(found[0].time) == len("2024-03-01 15:00:00")


def test_traffic_counts_over_several_batches_and_missing_keys(spark, inbox, folders):
    stream = timed(spark, inbox).select("ts", F.lit("1.1.1.1").alias("ip"), F.col("item").alias("cookie_id"))
    inbox.deliver("1 a", "2 b", "3")
    inbox.deliver("4 a", "70 c")
    inbox.deliver("900 z")
    run_to_end(traffic_windows(stream), folders[1], batches.batch_writer(folders[0]))
    found = spark.read.parquet(folders[0]).collect()
    assert sorted((seconds(r.window_start), r.pv, r.ips, r.uv) for r in found) == [(0, 4, 1, 2), (60, 1, 1, 1)]


def test_late_rows_are_dropped_one_batch_after_the_watermark(spark, inbox, folders):
    for lines in (["10 x", "600 x"], ["660 x"], ["20 x", "720 x"], ["1800 x"]):
        inbox.deliver(*lines)
    counts = item_windows(timed(spark, inbox), window="60 seconds", slide="60 seconds")
    query = start(counts, folders[1], batches.batch_writer(folders[0]))
    query.awaitTermination()
    found = spark.read.parquet(folders[0]).collect()
    assert sorted((seconds(r.window_start), r.n) for r in found) == [(0, 1), (600, 1), (660, 1), (720, 1)]
    dropped = [
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    ]
    assert sum(dropped) == 1


def test_late_row_in_the_next_batch_still_counts(spark, inbox, folders):
    for lines in (["10 x", "600 x"], ["20 x", "660 x"], ["1800 x"]):
        inbox.deliver(*lines)
    counts = item_windows(timed(spark, inbox), window="60 seconds", slide="60 seconds")
    run_to_end(counts, folders[1], batches.batch_writer(folders[0]))
    found = spark.read.parquet(folders[0]).collect()
    assert (0, 2) in [(seconds(r.window_start), r.n) for r in found]


def brute_windows(events, size=60, slide=20):
    counts = {}
    for at, item in events:
        first = at // slide * slide
        for begin in range(first - size + slide, first + 1, slide):
            counts[begin, item] = counts.get((begin, item), 0) + 1
    return counts


@pytest.fixture
def searches():
    pick = random.Random(2)
    return sorted((pick.randrange(0, 300), f"i{min(pick.randrange(9), 5)}") for _ in range(200))


def test_sliding_counts(spark, inbox, folders, searches):
    for at in range(0, 200, 50):
        inbox.deliver(*[f"{t} {i}" for t, i in searches[at : at + 50]])
    counts = item_windows(timed(spark, inbox), delay="10 minutes")
    run_to_end(counts, folders[1], batches.batch_writer(folders[0]), "update")
    rows = batches.read_batches(spark, folders[0], counts.schema)
    found = latest(rows, ["window_start", "item"], "n").collect()
    assert {(seconds(r.window_start), r["item"]): r.n for r in found} == brute_windows(searches)


def test_hottest_items(spark, inbox, folders, searches):
    for at in range(0, 200, 50):
        inbox.deliver(*[f"{t} {i}" for t, i in searches[at : at + 50]])
    inbox.deliver("9000 last")
    counts = item_windows(timed(spark, inbox))
    run_to_end(counts, folders[1], batches.batch_writer(folders[0], hottest()))
    found = spark.read.parquet(folders[0]).collect()
    by_window = {}
    for (begin, item), n in brute_windows(searches).items():
        by_window.setdefault(begin, []).append((-n, item))
    assert {(seconds(r.window_start), r["rank"], r["item"], r.n) for r in found} == {
        (begin, at, item, -n)
        for begin, entries in by_window.items()
        for at, (n, item) in enumerate(sorted(entries)[:3], 1)
    }


def test_hottest_searches_job(spark, inbox, folders):
    inbox.deliver("0 ann,shoes", "5 bob,shoes", "6 bob,hats", "7 eve")
    inbox.deliver("600 ann,end")
    lines = timed(spark, inbox).select(
        F.col("ts").alias("timestamp"), F.replace("item", F.lit(","), F.lit(" ")).alias("value")
    )
    jobs.hottest_searches(lines, *folders, every=None, n=1).awaitTermination()
    found = spark.read.parquet(folders[0]).where("window_start = '2024-01-01 00:00:00'").collect()
    assert [(r["item"], r.n) for r in found] == [("shoes", 2)]


def totals(spark, folder):
    return {r.key: r.total for r in batches.read_totals(spark, folder, schemas.COUNTS).collect()}


def test_clicks_per_user_with_rejects(spark, inbox, folders):
    inbox.deliver(click("u1", 5.0), click("u2", 1), '{"uid":"u"}')
    inbox.deliver('{"uid":', click("u1", 2))
    jobs.clicks_per_user(messages(spark, inbox), *folders, every=None).awaitTermination()
    assert totals(spark, folders[0]) == {"u1": 7, "u2": 1}
    rejects = spark.read.parquet(f"{folders[0]}/rejects").collect()
    assert {r.raw for r in rejects} == {'{"uid":"u"}', '{"uid":'}


def test_crash_after_writing_is_replayed_without_double_counting(spark, inbox, folders):
    out, checkpoint = folders
    add = batches.increment_writer(out, "uid", "click_count")
    clicks = parse_clicks(messages(spark, inbox)).where("valid")

    def fails_on_batch_one(batch, batch_id):
        add(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("executor lost")

    inbox.deliver(click("u1", 5.0), click("u2", 1))
    inbox.deliver(click("u1", 2.0))
    with pytest.raises(Exception, match="executor lost"):
        run_to_end(clicks, checkpoint, fails_on_batch_one)
    assert totals(spark, out) == {"u1": 7, "u2": 1}
    inbox.deliver(click("u2", 4))
    run_to_end(clicks, checkpoint, add)
    assert totals(spark, out) == {"u1": 7, "u2": 5}
    run_to_end(clicks, checkpoint, add)
    assert totals(spark, out) == {"u1": 7, "u2": 5}


def test_running_totals(spark, inbox, folders):
    inbox.deliver(click("u1", 5), click("u2", 1), "junk")
    inbox.deliver(click("u1", 2))
    stream = running_totals(parse_clicks(messages(spark, inbox)))
    run_to_end(stream, folders[1], batches.batch_writer(folders[0]), "update")
    rows = batches.read_batches(spark, folders[0], stream.schema)
    assert rows.count() == 3
    assert {r.uid: r.total for r in latest(rows, ["uid"], "total").collect()} == {"u1": 7, "u2": 1}


def test_interval_trigger_and_console(spark, inbox, folders, tmp_path):
    inbox.deliver(click("u1", 1))
    query = jobs.clicks_per_user(messages(spark, inbox), *folders, every="1 second")
    console = to_console(messages(spark, inbox), str(tmp_path / "console"), every="1 second")
    try:
        query.processAllAvailable()
        inbox.deliver(click("u1", 3))
        query.processAllAvailable()
        console.processAllAvailable()
        assert totals(spark, folders[0]) == {"u1": 4}
        assert console.lastProgress is not None
    finally:
        query.stop()
        console.stop()


def test_replay_picks_files_by_pattern(spark, tmp_path, folders):
    for name, n in (("a", 2), ("b", 3)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / "tables" / name))
    for name in "ab":
        part = next((tmp_path / "tables" / name).glob("part-*"))
        part.rename(tmp_path / "tables" / f"{name}.parquet")
    stream = replay_stream(spark, str(tmp_path / "tables"), spark.range(1).schema, "b.parquet")
    run_to_end(stream, folders[1], batches.batch_writer(folders[0]))
    assert spark.read.parquet(folders[0]).count() == 3


def test_state_partitions_are_the_streams_own(spark, inbox, folders):
    inbox.deliver(click("u1", 5))
    stream = running_totals(parse_clicks(messages(spark, inbox)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    writer = batches.batch_writer(folders[0])
    start(stream, folders[1], writer, "update", partitions=3).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(os.listdir(f"{folders[1]}/state/0")) - os.path.isdir(f"{folders[1]}/state/0/_metadata") == 3


def test_events_may_be_a_folder_of_files(spark, small, tmp_path):
    from tidemill.catalog.streams import QUERIES

    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_batch_sql", "stream_running_totals"):
        one = sorted(map(tuple, QUERIES[name](spark, small).collect()))
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect())) == one


@pytest.mark.parametrize("early, windows, dropped", [(False, [1, 1, 1, 1], 1), (True, [2, 1, 1, 1], 0)])
def test_late_rows_are_counted_beside_the_output(spark, inbox, folders, tmp_path, early, windows, dropped):
    """One minute of watermark: 00:00:20 after a batch that closed its window is late, with that batch it is not."""
    deliveries = [["10 x", "600 x"], ["660 x"], ["720 x"], ["1800 x"]]
    deliveries[1 if early else 2].insert(0, "20 x")
    for lines in deliveries:
        inbox.deliver(*lines)
    counts = item_windows(timed(spark, inbox), window="60 seconds", slide="60 seconds")
    with late_rows(spark, str(tmp_path / "late"), "searches") as listener:
        query = start(counts, folders[1], batches.batch_writer(folders[0]), name="searches")
        query.awaitTermination()
        listener.finish(query)
    found = spark.read.parquet(folders[0]).collect()
    assert sorted((seconds(r.window_start), r.n) for r in found) == list(zip([0, 600, 660, 720], windows))
    late = read_late(spark, str(tmp_path / "late")).orderBy("batch_id").collect()
    assert sum(r.late_rows for r in late) == dropped
    assert sum(r.input_rows for r in late) == 6
    assert [r.batch_id for r in late] == list(range(len(late)))
    if dropped:
        assert [r.batch_id for r in late if r.late_rows] == [r.batch_id for r in late if r.input_rows == 2][1:2]


def test_sketches_unite_in_any_order(spark, inbox, folders):
    visits = [(s, f"c{s * 7919 % 900}") for s in range(0, 3_000)]
    for at in range(0, 3_000, 500):
        inbox.deliver(*[f"{s} {c}" for s, c in visits[at : at + 500]])
    inbox.deliver("90000 end")
    stream = timed(spark, inbox).select("ts", F.lit("1.1.1.1").alias("ip"), F.col("item").alias("cookie_id"))
    run_to_end(visitor_sketches(stream, "10 minutes"), folders[1], batches.batch_writer(folders[0]))
    sketches = spark.read.parquet(folders[0])
    assert sketches.count() == 5
    day = united(sketches, F.to_date("window_start")).first()
    assert day.pv == 3_000 and abs(day.uv - 900) <= 27
    for order in (F.asc("window_start"), F.desc("window_start")):
        again = united(sketches.repartition(3).sortWithinPartitions(order), F.to_date("window_start")).first()
        assert again.uv == day.uv
    halves = sketches.groupBy((F.minute("window_start") < 20).alias("half")).agg(
        F.sum("pv").alias("pv"), F.hll_union_agg("visitors").alias("visitors")
    )
    assert united(halves, F.lit(1)).first().uv == day.uv


def test_stream_counts_its_rejects(spark, inbox, folders):
    inbox.deliver(click("a", 1), '{"uid":', '{"uid":"u"}')
    inbox.deliver(click("b", 2), "nothing")
    clicks = accepted(parse_clicks(messages(spark, inbox)), F.col("valid"))
    query = start(clicks, folders[1], batches.batch_writer(folders[0]))
    query.awaitTermination()
    assert counted_in_stream(query) == {"accepted": 2, "rejected": 3}
    assert spark.read.parquet(folders[0]).count() == 2


def ledger_run(spark, inbox, out, checkpoint):
    ledger = Ledger(spark, out, checkpoint)
    placed = ledger.unread(file_place(messages(spark, inbox)))
    clicks = parse_clicks(placed, keep=["source", "position"])
    run_to_end(clicks, checkpoint, ledger.writer("uid", "click_count"))
    return {r.key: r.total for r in ledger.totals().collect()}, ledger


def test_totals_survive_the_loss_of_the_checkpoint(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    inbox.deliver(click("a", 1), click("b", 10), "broken")
    inbox.deliver(click("a", 2))
    assert ledger_run(spark, inbox, out, str(tmp_path / "c1"))[0] == {"a": 3, "b": 10}
    inbox.deliver(click("a", 4))
    # another checkpoint begins at the first file again
    assert ledger_run(spark, inbox, out, str(tmp_path / "c2"))[0] == {"a": 7, "b": 10}
    inbox.deliver(click("b", 5))
    found, ledger = ledger_run(spark, inbox, out, str(tmp_path / "c2"))
    assert found == {"a": 7, "b": 15} and ledger.epoch == 2
    assert ledger_run(spark, inbox, out, str(tmp_path / "c3"))[0] == found
    files = ledger.ranges().groupBy("source").agg(F.sum("rows").alias("rows"))
    assert sorted(r.rows for r in files.collect()) == [1, 1, 1, 3]


def test_batch_that_stopped_before_its_ranges_does_not_count(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    inbox.deliver(click("a", 1))
    spark.createDataFrame([("a", 1)], "key string, total bigint").write.parquet(f"{out}/sums/epoch=1/batch_id=0")
    assert ledger_run(spark, inbox, out, str(tmp_path / "c"))[0] == {"a": 1}


def test_replayed_batch_leaves_the_ledger_alone(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "out"), str(tmp_path / "c"))
    rows = spark.createDataFrame([("a", 1, "t/0", 5), ("a", 2, "t/1", 9)], "uid string, n int, source string, position bigint")
    write = ledger.writer("uid", "n")
    write(rows, 0)
    write(rows.limit(1), 0)
    write(rows.limit(0), 1)
    assert [(r.key, r.total) for r in ledger.totals().collect()] == [("a", 3)]
    assert json.loads(ledger.starting_offsets()) == {"t": {"0": 6, "1": 10}}


def test_kafka_rows_behind_the_ledger_are_left_out(spark, tmp_path):
    rows = spark.createDataFrame([("t", 0, o, "x") for o in range(10)], "topic string, partition int, offset bigint, value string")
    first = Ledger(spark, str(tmp_path / "out"), str(tmp_path / "c1"))
    first.writer("value", "one")(kafka_place(rows.where("offset < 6")).withColumn("one", F.lit(1)), 0)
    then = Ledger(spark, str(tmp_path / "out"), str(tmp_path / "c2"))
    assert sorted(r.offset for r in then.unread(kafka_place(rows)).collect()) == [6, 7, 8, 9]
