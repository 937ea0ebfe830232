"""Sources, filters, joins, aggregates, ranking and sinks."""

from __future__ import annotations

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.catalog.tables import (
    PURCHASES_SQL,
    USERS_SQL,
    access_log,
    people,
    purchases,
    registrar,
    table,
    text,
    users,
    with_customer,
    written_lines,
)
from tidemill.functions.fields import clock_text, date_prefix, unpadded_date
from tidemill.functions.ids import decode, dense_ids, encode
from tidemill.operators import people as p
from tidemill.operators import purchases as b
from tidemill.operators import rejects
from tidemill.operators.als import history_of, titles_in
from tidemill.operators.frequent import frequent_keys
from tidemill.operators.skew import lookup
from tidemill.operators import traffic as t
from tidemill.session import new_folder, stage
from tidemill.sinks.text import write_sorted_text
from tidemill.sources import text as src
from tidemill.sources.streams import parse_clicks

QUERIES, ORACLES = {}, {}
query = registrar(QUERIES, ORACLES)


# --- sources and parsing -------------------------------------------------------------------


@query("SELECT concat_ws(' ', CAST(p_partkey AS VARCHAR), p_name, p_brand) AS line FROM part")
def src_text_lines(spark, folder):
    line = F.concat_ws(" ", text("p_partkey"), "p_name", "p_brand")
    path = written_lines(table(spark, folder, "part"), line, "lines")
    return src.read_lines(spark, f"{path}/part-*")


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS gender,
       CAST(10 + c_custkey % 50 AS INTEGER) AS age,
       (2000 + c_custkey % 16) || '-' || (1 + c_custkey % 12) || '-' || (1 + c_custkey % 28)
           AS register_date,
       'ROLE00' || (c_nationkey % 5 + 1) AS role, 'REG00' || (c_custkey % 5 + 1) AS region
FROM customer"""
)
def parse_space_delimited(spark, folder):
    line = F.expr(
        "concat_ws(' ', c_custkey, c_mktsegment, 10 + c_custkey % 50, concat_ws('-', "
        "2000 + c_custkey % 16, 1 + c_custkey % 12, 1 + c_custkey % 28), "
        "concat('ROLE00', c_nationkey % 5 + 1), concat('REG00', c_custkey % 5 + 1))"
    )
    path = written_lines(table(spark, folder, "customer"), line, "users")
    return src.read_delimited(spark, path, schemas.USERS)


@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
       l_quantity AS pref FROM lineitem"""
)
def parse_csv_prefs(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.concat_ws(" , ", text("l_orderkey"), text("l_partkey"), text("l_quantity")).alias("line")
    )
    return src.parse_fields(lines, schemas.PREFS, ",", trim=True, strict=True)


@query(
    """
SELECT 'accepted' AS outcome, count(*) AS n FROM events
WHERE event_type NOT IN ('error', 'signup')
UNION ALL
SELECT 'rejected', count(*) FROM events WHERE event_type IN ('error', 'signup')"""
)
def parse_rejects(spark, folder):
    lines = table(spark, folder, "events").select(
        F.expr(
            "CASE event_type WHEN 'error' THEN concat_ws(',', user_id, event_id) "
            "WHEN 'signup' THEN concat_ws(',', user_id, event_id, 'x') "
            "ELSE concat_ws(',', user_id, event_id, value) END"
        ).alias("line")
    )
    good, bad = src.split_rejects(lines, schemas.PREFS, ",")
    outcomes = good.select(F.lit("accepted").alias("outcome")).unionByName(
        bad.select(F.lit("rejected").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS ip,
       CASE WHEN event_type = 'purchase' THEN '' ELSE CAST(user_id AS VARCHAR) END AS cookie_id
FROM events"""
)
def parse_multichar_delim(spark, folder):
    return _log_lines(spark, folder).select("day", "ip", "cookie_id")


def _log_lines(spark, folder):
    line = F.expr(
        "concat_ws('|~|', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'x', event_type, 'x', 'x', "
        "'x', if(event_type = 'purchase', '', string(user_id)))"
    )
    return src.parse_access_log(table(spark, folder, "events").select(line.alias("line")))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def log_day(spark, folder):
    return _log_lines(spark, folder).groupBy("day").agg(F.count("*").alias("n"))


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS client, o_orderstatus AS city, o_orderpriority AS keyword,
       CAST(o_custkey AS VARCHAR) AS area
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'"""
)
def parse_min_fields(spark, folder):
    # Whole lines have 22 fields. Status P gives 16 fields; 5-LOW leaves the last two empty,
    # which makes 20; 1-URGENT leaves only the last one empty, which makes 21.
    line = F.expr(
        "concat_ws(',', array(string(o_orderkey), o_orderstatus, "
        "concat('\"', o_orderpriority, '\"')), array_repeat('f', 12), string(o_custkey), "
        "if(o_orderstatus = 'P', array(), array_repeat('f', 4)), "
        "if(o_orderstatus = 'P', array(), "
        "array(if(o_orderpriority = '5-LOW', '', 'f'), "
        "if(o_orderpriority IN ('5-LOW', '1-URGENT'), '', 'f'))))"
    )
    return src.parse_house(table(spark, folder, "orders").select(line.alias("line")))


@query(
    f"""
SELECT p.order_id, p.product_id, p.price FROM {PURCHASES_SQL} p WHERE p.price > 250000"""
)
def sql_temp_view(spark, folder):
    purchases(spark, folder).createOrReplaceTempView("purchases_view")
    return spark.sql(
        "SELECT v.order_id, v.product_id, v.price FROM purchases_view v WHERE v.price > 250000"
    )


@query(
    """
SELECT movie_id, title FROM (
  SELECT p_size AS movie_id, p_name || ',' || p_type AS title,
         row_number() OVER (PARTITION BY p_size ORDER BY p_partkey DESC) AS place
  FROM part WHERE p_brand <> 'Brand#1') WHERE place = 1"""
)
def dim_movies(spark, folder):
    lines = table(spark, folder, "part").select(
        "p_partkey",
        F.expr(
            "concat_ws(',', if(p_brand = 'Brand#1', '', string(p_size)), p_retailprice, p_name, "
            "p_type)"
        ).alias("line"),
    )
    return src.parse_movies(lines, order="p_partkey")


@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
       CAST(CASE WHEN l_linenumber = 1 THEN 3 ELSE l_linenumber - 2 END AS DOUBLE) AS rating
FROM lineitem"""
)
def rating_clean(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.expr("concat_ws(', ', l_orderkey, l_partkey, l_linenumber - 2)").alias("line")
    )
    return src.parse_ratings(lines)


# --- filters -------------------------------------------------------------------------------


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS gender, c_acctbal AS height
FROM customer WHERE c_acctbal > 180 AND c_mktsegment = 'MACHINERY'"""
)
def filter_gt_and_eq(spark, folder):
    return p.taller_than(people(spark, folder), "MACHINERY", 180)


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS gender, c_acctbal AS height
FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 210
ORDER BY CAST(c_custkey AS VARCHAR) LIMIT 50"""
)
def filter_chained(spark, folder):
    chosen = people(spark, folder).filter(F.col("gender") == "BUILDING").filter(F.col("height") > 210)
    return chosen.orderBy("id").limit(50)


@query(f"SELECT * FROM {PURCHASES_SQL} WHERE contains(order_date, '1997')")
def filter_contains(spark, folder):
    return b.mentioning(purchases(spark, folder), "1997")


@query(f"SELECT * FROM {PURCHASES_SQL} WHERE order_date LIKE '1996%'")
def filter_like_prefix(spark, folder):
    return b.dated(purchases(spark, folder), "1996")


@query(
    """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_day, count(*) AS n
FROM orders GROUP BY 1"""
)
def unpadded_dates(spark, folder):
    day = F.date_format(unpadded_date("order_date"), "yyyy-MM-dd").alias("order_day")
    return purchases(spark, folder).groupBy(day).agg(F.count("*").alias("n"))


# --- joins ---------------------------------------------------------------------------------


@query(
    f"""
SELECT count(*) AS orders FROM {PURCHASES_SQL} o JOIN {USERS_SQL} u ON o.user_id = u.user_id
WHERE contains(order_date, '1997')"""
)
def join_filter_count(spark, folder):
    chosen = b.mentioning(purchases(spark, folder), "1997")
    return b.known_purchase_count(chosen, users(spark, folder))


@query(
    f"""
SELECT count(DISTINCT u.user_id) AS buyers
FROM {PURCHASES_SQL} o JOIN {USERS_SQL} u ON o.user_id = u.user_id
WHERE contains(order_date, '1997')"""
)
def join_distinct_buyers(spark, folder):
    chosen = b.mentioning(purchases(spark, folder), "1997")
    return b.buyer_count(chosen, users(spark, folder))


@query(
    f"""
SELECT o.order_id, o.product_id, o.price, u.user_id
FROM {PURCHASES_SQL} o, {USERS_SQL} u WHERE u.user_id = 1 AND u.user_id = o.user_id"""
)
def join_point_lookup(spark, folder):
    return b.purchases_of(purchases(spark, folder), users(spark, folder), 1)


_STATS_SQL = f"""
SELECT max(o.price) AS max_price, min(o.price) AS min_price, round(avg(o.price), 6) AS avg_price,
       u.user_id
FROM {PURCHASES_SQL} o, {USERS_SQL} u WHERE u.user_id = o.user_id"""


def _rounded(stats):
    return stats.withColumn("avg_price", F.round("avg_price", 6))


@query(f"{_STATS_SQL} GROUP BY u.user_id")
def join_group_stats(spark, folder):
    return _rounded(b.price_stats(purchases(spark, folder), users(spark, folder)))


@query(f"{_STATS_SQL} AND u.user_id = 10 GROUP BY u.user_id")
def join_point_stats(spark, folder):
    return _rounded(b.price_stats(purchases(spark, folder), users(spark, folder), 10))


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_name, '') AS title
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON l_partkey = p_partkey"""
)
def broadcast_dim_lookup(spark, folder):
    titles = (
        table(spark, folder, "part")
        .where(F.col("p_size") <= 25)
        .select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("title"))
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(lines, titles, "l_partkey").withColumn("title", F.coalesce("title", F.lit("")))


@query(
    """
SELECT p_partkey AS item_id, p_name AS title FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)"""
)
def semi_join_titles(spark, folder):
    titles = table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title")
    )
    bulk = table(spark, folder, "lineitem").where(F.col("l_quantity") == 50)
    return titles_in(titles, bulk.select(F.col("l_partkey").alias("item_id")))


@query(
    """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, l_partkey AS item_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000"""
)
def user_history(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    ratings = with_customer(spark, folder, lines, lines).select(
        text("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    )
    wanted = table(spark, folder, "customer").where(F.col("c_acctbal") > 5000)
    return history_of(ratings, wanted.select(text("c_custkey").alias("user_id")))


# --- aggregates ----------------------------------------------------------------------------


@query("SELECT count(*) AS people FROM customer WHERE c_acctbal > 170 AND c_mktsegment = 'FURNITURE'")
def agg_count(spark, folder):
    chosen = p.taller_than(people(spark, folder), "FURNITURE", 170)
    return chosen.agg(F.count("*").alias("people"))


@query("SELECT c_mktsegment AS gender, count(*) AS count FROM customer GROUP BY 1")
def group_count(spark, folder):
    return p.count_by_gender(people(spark, folder))


@query("SELECT round(avg(c_acctbal), 6) AS avg_height FROM customer WHERE c_mktsegment = 'MACHINERY'")
def agg_avg_filtered(spark, folder):
    average = p.average_height(people(spark, folder), "MACHINERY")
    return average.select(F.round("avg_height", 6).alias("avg_height"))


@query("SELECT max(c_acctbal) AS max_height FROM customer WHERE c_mktsegment = 'HOUSEHOLD'")
def agg_max_filtered(spark, folder):
    return p.greatest_height(people(spark, folder), "HOUSEHOLD")


@query(
    """
SELECT count(*) AS pv, count(DISTINCT event_type) AS ips, count(DISTINCT user_id) AS uv
FROM events"""
)
def pv_ip_uv_batch(spark, folder):
    return t.pv_ip_uv(access_log(spark, folder))


@query("SELECT l_partkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def sum_by_key(spark, folder):
    return t.sum_by_key(table(spark, folder, "lineitem"), "l_partkey", "l_quantity")


@query(
    """
SELECT CAST(user_id AS VARCHAR) AS uid,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total
FROM events GROUP BY 1"""
)
def json_sum_by_key(spark, folder):
    clicks = parse_clicks(click_messages(table(spark, folder, "events"))).where("valid")
    return t.sum_by_key(clicks, "uid", "click_count")


def click_messages(events, keep=()):
    """Events as the JSON messages of a click stream, with the columns of ``keep``."""
    return events.select(
        *keep,
        F.to_json(
            F.struct(
                text("user_id").alias("uid"),
                F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("event_time"),
                F.lit("Android").alias("os_type"),
                F.get_json_object("props", "$.k").cast("int").alias("click_count"),
            )
        ).alias("value")
    )


@query("SELECT DISTINCT o_custkey AS user_id FROM orders")
def distinct_keys(spark, folder):
    return purchases(spark, folder).select("user_id").distinct()


_STATS = """count(v) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS stdev,
       CAST(max(v) AS DOUBLE) AS max, CAST(min(v) AS DOUBLE) AS min"""


@query(
    f"""
SELECT 'users' AS name, {_STATS} FROM (
  SELECT row_number() OVER (ORDER BY k) - 1 AS v FROM (SELECT DISTINCT o_custkey AS k FROM orders))
UNION ALL
SELECT 'items', {_STATS} FROM (SELECT DISTINCT l_partkey AS v FROM lineitem)"""
)
def column_stats(spark, folder):
    codes = dense_ids(purchases(spark, folder), "user_id")
    items = table(spark, folder, "lineitem").select("l_partkey").distinct()
    both = [(codes, "users", "code"), (items, "items", "l_partkey")]
    parts = [
        t.column_stats(df.select(F.col(c).cast("double").alias(c)), c).select(
            F.lit(name).alias("name"),
            "n",
            F.round("mean", 6).alias("mean"),
            F.round("stdev", 6).alias("stdev"),
            "max",
            "min",
        )
        for df, name, c in both
    ]
    return parts[0].unionByName(parts[1])


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS gender, c_acctbal AS height
FROM customer ORDER BY c_acctbal DESC, CAST(c_custkey AS VARCHAR) LIMIT 50"""
)
def topk_global(spark, folder):
    return p.tallest(people(spark, folder), 50)


@query(
    """
SELECT strftime(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS time,
       count(*) AS pv
FROM events GROUP BY 1"""
)
def fmt_window_end(spark, folder):
    log = access_log(spark, folder)
    counts = log.groupBy(F.window("ts", "1 hour")).agg(F.count("*").alias("pv"))
    return counts.select(clock_text("window.end").alias("time"), "pv")


# --- ids -----------------------------------------------------------------------------------


@query(
    """
SELECT user_id, row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR)), user_id) - 1 AS code
FROM (SELECT DISTINCT o_custkey AS user_id FROM orders)"""
)
def dense_user_id(spark, folder):
    return dense_ids(purchases(spark, folder), "user_id")


@query("SELECT o_orderkey AS order_id, o_custkey AS user_id FROM orders")
def reverse_user_id(spark, folder):
    rows = purchases(spark, folder).select("order_id", "user_id")
    ids = dense_ids(rows, "user_id")
    coded = encode(rows, ids, "user_id").select("order_id", "code")
    return decode(coded, ids, "code").select("order_id", "user_id")


# --- sinks ---------------------------------------------------------------------------------


@query(
    """
SELECT CAST(row_number() OVER (ORDER BY line) AS BIGINT) AS place, line FROM (
  SELECT o_orderpriority || ',' || o_orderkey AS line FROM orders)"""
)
def sink_sorted_text(spark, folder):
    """Read back with each line's place: its place in its file, after all files named before."""
    path = new_folder(spark, "sorted")
    orders = table(spark, folder, "orders")
    line = F.concat_ws(",", "o_orderpriority", text("o_orderkey"))
    write_sorted_text(orders, path, ["o_orderpriority"], line)
    return text_in_order(spark, path)


def text_in_order(spark, path):
    """Lines of a folder of text files, numbered in file name order."""
    lines = src.read_lines(spark, path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "line",
    )
    # One size per file block, summed up in one place.
    sizes = lines.groupBy("file", "block").agg(F.count("*").alias("size"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("file", "block").orderBy("row")
    return (
        lines.withColumn("place", F.row_number().over(inside))
        .join(starts, ["file", "block"])
        .select((F.col("start") + F.col("place")).alias("place"), "line")
    )


# --- rejects, typed prefixes, order of lines, frequent keys -----------------------------------

_OUTCOMES = """
SELECT 'accepted' AS outcome, count(*) FILTER (NOT {0}) AS n FROM events
UNION ALL SELECT 'rejected', count(*) FILTER ({0}) FROM events"""


def _outcomes(spark, counts):
    return spark.createDataFrame(sorted(counts.items()), "outcome string, n bigint")


@query(_OUTCOMES.format("event_type IN ('error', 'signup')"))
def log_rejects(spark, folder):
    """Log lines with an unreadable time or too few fields, counted while the others are written."""
    lines = table(spark, folder, "events").select(
        F.expr(
            "CASE event_type WHEN 'error' THEN concat_ws('|~|', 'yesterday', '', 'ip', '', '', '', user_id) "
            "WHEN 'signup' THEN concat('|~|', event_id) "
            "ELSE concat_ws('|~|', ts, '', event_type, '', '', '', user_id) END"
        ).alias("line")
    )
    observation = Observation()
    stage(src.parse_timed_log(lines, observation), "log-rows")
    return _outcomes(spark, rejects.counted(observation))


@query(_OUTCOMES.format("event_type = 'error'"))
def search_rejects(spark, folder):
    """Search lines without an item."""
    lines = table(spark, folder, "events").select(
        F.expr("if(event_type = 'error', string(user_id), concat_ws(' ', user_id, event_type))").alias("line")
    )
    observation = Observation()
    stage(src.parse_search(lines, observation), "searches")
    return _outcomes(spark, rejects.counted(observation))


_IN_1996 = "(order_date LIKE '1996%' OR order_date LIKE '1997-1%')"


@query(
    f"""
SELECT order_id, order_date, price FROM {PURCHASES_SQL} WHERE {_IN_1996}"""
)
def orders_in_year(spark, folder):
    """Orders whose date text begins with 1996 or 1997-1, by ranges of the typed date that reach the scan."""
    inside = date_prefix("o_orderdate", "1996") | date_prefix("o_orderdate", "1997-1")
    return table(spark, folder, "orders").where(inside).select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-M-d").alias("order_date"),
        F.floor("o_totalprice").cast("int").alias("price"),
    )


@query(
    """
SELECT movie_id, title FROM (
  SELECT p_size AS movie_id, p_name AS title,
         row_number() OVER (PARTITION BY p_size ORDER BY p_name) AS place
  FROM part) WHERE place = 1"""
)
def dim_movies_last(spark, folder):
    """Of repeated ids over several files, the last line's title; titles descend from file to file, so it is the least one."""
    order = F.desc("p_name")
    parts = table(spark, folder, "part").repartitionByRange(4, order).sortWithinPartitions(order)
    line = F.concat_ws(",", "p_size", "p_retailprice", "p_name")
    path = written_lines(parts, line, "movies")
    return src.parse_movies(src.read_ordered_lines(spark, path), order="line_order")


@query("SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 100")
def heavy_keys_sketch(spark, folder):
    """Users with over 100 events, by summaries of the tasks and a count of their candidates only."""
    events = table(spark, folder, "events")
    found = frequent_keys(events, "user_id", 100, events.count())
    return found.select(text("key").alias("key"), "n")
