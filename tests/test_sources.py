import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions.fields import date_prefix
from tidemill.operators import rejects
from tidemill.operators.traffic import pv_ip_uv
from tidemill.sources import text as src
from tidemill.sources.streams import kafka_options, parse_clicks



def log_line(time, ip, cookie):
    return "|~|".join([f"2024-03-01T{time}", "-", ip, "-", "-", "-", cookie])


# Six views by two addresses and five visitors, on both sides of a full minute.
LOG = [
    log_line("14:59:59", "10.0.0.1", "c1"),
    log_line("14:59:59", "10.0.0.2", "c2"),
    log_line("14:59:59", "10.0.0.2", "c3"),
    log_line("15:00:00", "10.0.0.2", "c4"),
    log_line("15:00:00", "10.0.0.2", "c4"),
    log_line("15:00:01", "10.0.0.2", "c5"),
]


def test_lines_of_globbed_files(spark, tmp_path):
    (tmp_path / "house1").write_text("a\nb\n")
    (tmp_path / "house2").write_text("c\n")
    (tmp_path / "other").write_text("d\n")
    found = src.read_lines(spark, f"{tmp_path}/house*").collect()
    assert sorted(r.line for r in found) == ["a", "b", "c"]


def test_delimited_file_is_typed(spark, tmp_path, rows):
    (tmp_path / "people").write_text('1 M 181\n2 F 99.5\n3 "M 170\n')
    people = src.read_delimited(spark, str(tmp_path / "people"), schemas.PEOPLE)
    assert people.schema == schemas.PEOPLE
    assert rows(people) == [("1", "M", 181.0), ("2", "F", 99.5), ("3", '"M', 170.0)]


def test_malformed_delimited_file_fails(spark, tmp_path):
    (tmp_path / "people").write_text("1 M tall\n")
    with pytest.raises(Exception, match="MALFORMED"):
        src.read_delimited(spark, str(tmp_path / "people"), schemas.PEOPLE).collect()


def test_malformed_delimited_file_fails_whatever_is_read(spark, tmp_path):
    (tmp_path / "people").write_text("1 M 180\n2 F tall\n")
    people = src.read_delimited(spark, str(tmp_path / "people"), schemas.PEOPLE)
    with pytest.raises(Exception, match="MALFORMED"):
        people.groupBy("gender").count().collect()
    with pytest.raises(Exception, match="MALFORMED"):
        people.count()


def test_fields_are_trimmed_and_cast(lines, rows):
    parsed = src.parse_fields(lines(" 7 , 1, 2.5 "), schemas.PREFS, ",", trim=True)
    assert rows(parsed) == [("7", "1", 2.5)]


def test_bad_number_is_null_or_fails(lines):
    bad = lines("7,1,x")
    assert src.parse_fields(bad, schemas.PREFS, ",").first().pref is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        src.parse_fields(bad, schemas.PREFS, ",", strict=True).collect()


def test_rejects_are_kept_and_do_not_stop_the_rest(lines, rows):
    good, bad = src.split_rejects(lines("7,1", "7,1,x", "7,2,3"), schemas.PREFS, ",")
    assert rows(good) == [("7", "2", 3.0)]
    assert rows(bad) == [("7,1",), ("7,1,x",)]


def test_multi_character_separator_keeps_trailing_empty_fields(lines):
    schema = schemas._struct(a=schemas.StringType, b=schemas.StringType, c=schemas.StringType)
    row = src.parse_fields(lines("a|~|b|~|"), schema, "|~|").first()
    assert tuple(row) == ("a", "b", "")


def test_access_log_sample(lines):
    log = src.parse_access_log(lines(*LOG))
    assert {r.day for r in log.collect()} == {"2024-03-01"}
    assert tuple(pv_ip_uv(log).first()) == (6, 2, 5)


def test_house_rows_need_more_than_twenty_fields(lines, rows):
    def line(n, tail=0):
        return ",".join([f'"{i}"' if i == 2 else str(i) for i in range(n)] + [""] * tail)

    parsed = src.parse_house(lines(line(20), line(21), line(20, 3), line(21, 3), ""))
    assert rows(parsed) == [("0", "1", "2", "15")] * 2


def test_house_counts_an_empty_field_before_a_full_one(lines):
    fields = ["c", "t", "k"] + [""] * 12 + ["area"] + [""] * 4 + ["last"]
    assert src.parse_house(lines(",".join(fields))).first().area == "area"


def test_search_without_an_item_is_dropped(lines, rows):
    assert rows(src.parse_search(lines("onlyname", "ann shoes"))) == [("ann", "shoes")]


def test_unscored_movie_counts_as_three(lines, rows):
    parsed = src.parse_ratings(lines("u1, 10, -1", "u1,11,5", "u2,10,0"))
    assert rows(parsed) == [("u1", 10, 3.0), ("u1", 11, 5.0), ("u2", 10, 0.0)]


def test_movies(spark, lines, rows):
    parsed = src.parse_movies(lines("1,8.2,a,b", ",9,nobody", "2,7.1,c"))
    assert rows(parsed) == [(1, "a,b"), (2, "c")]
    numbered = spark.createDataFrame([("1,1,old", 1), ("1,1,a new one", 2)], "line string, at int")
    assert rows(src.parse_movies(numbered, order="at")) == [(1, "a new one")]


def test_clicks(lines):
    messages = lines(
        '{"uid":"u1","event_time":"1000","os_type":"Android","click_count":5.0}',
        '{"uid":"u2","click_count":6}',
        '{"uid":"u"}',
        '{"uid":',
        '{"uid":"u3","event_time":"soon","click_count":"many"}',
        None,
        column="value",
    )
    clicks = parse_clicks(messages).collect()
    assert [(c.uid, c.click_count) for c in clicks if c.valid] == [("u1", 5), ("u2", 6)]
    assert clicks[0].event_time.timestamp() == 1 and clicks[0].os_type == "Android"
    assert len(clicks) == 6


def test_kafka_options():
    options = kafka_options(["a:1", "b:1"], ["log", "log"], {"log": {0: 5}}, 10, "clicks")
    assert options["kafka.bootstrap.servers"] == "a:1,b:1"
    assert options["subscribe"] == "log"
    assert options["startingOffsets"] == '{"log": {"0": 5}}'
    assert options["maxOffsetsPerTrigger"] == "10"
    assert options["kafka.group.id"] == "clicks"
    assert kafka_options(["a:1"], ["log"])["startingOffsets"] == "earliest"


def test_strange_numbers_make_a_click_invalid(lines):
    from tidemill.sources.streams import parse_clicks

    message = '{"uid":"u","event_time":"%s","os_type":"x","click_count":%s}'
    cases = [("1", "1e300"), ("1", '"NaN"'), ("9223372036854775807", "5.7"), ("1", "9007199254740993")]
    found = parse_clicks(lines(*[message % case for case in cases], column="value")).collect()
    assert [r.valid for r in found] == [False, False, True, True]
    assert [r.click_count for r in found] == [None, None, 5, 9007199254740993]
    assert found[2].event_time is None


def test_last_line_of_several_files_wins(spark, tmp_path):
    (tmp_path / "a").write_text("1,8,first\n2,8,zeta\n2,8,alpha\n")
    (tmp_path / "b").write_text("1,8,b, with comma\n,8,nobody\n" + "9,1,filler\n" * 200 + "9,1,end\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        lines = src.read_ordered_lines(spark, str(tmp_path))
        found = {r.movie_id: r.title for r in src.parse_movies(lines, order="line_order").collect()}
        assert lines.rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {1: "b, with comma", 2: "alpha", 9: "end"}


def test_rejects_are_counted_in_the_same_pass(lines):
    seen = Observation()
    good = src.parse_search(lines("onlyname", "ann shoes", "", "bob hat"), seen)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "CollectMetrics" in plan
    assert good.count() == 2
    assert rejects.counted(seen) == {"accepted": 2, "rejected": 2}
    seen = Observation()
    log = src.parse_timed_log(lines(*LOG, "yesterday|~||~|ip|~||~||~||~|c", "short"), seen)
    assert log.count() == 6
    assert rejects.counted(seen) == {"accepted": 6, "rejected": 2}


PREFIXES = ["", "1", "19", "199", "1996", "19965", "1996-", "1996-1", "1996-12", "1996-12-", "1996-12-1", "1996-12-31", "1996-2-29",
            "1997-2-29", "1996-02", "1996-13", "9999", "9999-12-31", "x", "1996-1-1-", "0", "-", "1996--1"]


def test_date_prefixes_are_ranges_with_the_same_days(spark):
    days = spark.sql("SELECT explode(sequence(date'1995-12-01', date'1998-03-05')) AS day").union(
        spark.sql("SELECT explode(array(date'0001-01-01', date'0019-05-01', date'9999-12-31', date'9999-12-01', null))")
    )
    days = days.withColumn("at", F.date_format("day", "yyyy-M-d"))
    days = days.withColumn("at", F.concat_ws("-", F.year("day"), F.month("day"), F.day("day"))).persist()
    for prefix in PREFIXES:
        by_range = days.where(date_prefix("day", prefix)).count()
        by_text = days.where(F.col("day").isNotNull() & F.col("at").startswith(prefix)).count()
        assert by_range == by_text, prefix


def test_date_prefix_reaches_the_scan(spark, small):
    from tidemill.catalog import queries

    plan = queries()["orders_in_year"](spark, small)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in pushed and "LessThan(o_orderdate,1997-01-01" in pushed
