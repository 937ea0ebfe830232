from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemill.functions.fields import ranked_titles
from tidemill.functions.ids import bucket_digits, decode, dense_ids, encode


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(max_size=4)), max_size=40))
def test_codes_are_dense_and_stable(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    codes = {r.k: r.code for r in dense_ids(df, "k").collect()}
    distinct = {k for k in keys if k is not None}
    assert set(codes) == distinct
    assert sorted(codes.values()) == list(range(len(distinct)))
    again = dense_ids(df.orderBy("k").repartition(3), "k")
    assert {r.k: r.code for r in again.collect()} == codes


def test_codes_lead_back_to_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, n int")
    ids = dense_ids(df, "k")
    coded = encode(df, ids, "k", rows_per_slice=1).select("code", "n")
    assert rows(decode(coded, ids, "code", rows_per_slice=1), "k", "n") == rows(df)
    unknown = spark.createDataFrame([(99, 1)], "code bigint, n int")
    assert decode(unknown, ids, "code").count() == 0


def test_ranked_titles(spark, rows):
    df = spark.createDataFrame(
        [("u", 2, 7, None), ("u", 1, 9, "T,x"), ("u", 10, 8, "last"), ("v", 1, 7, None)],
        "user string, rank int, item int, title string",
    )
    text = df.groupBy("user").agg(ranked_titles("rank", "item", "title").alias("t"))
    assert rows(text) == [("u", "9:T,x,7:,8:last"), ("v", "7:")]


def test_numbers_do_not_hang_on_the_buckets(spark, rows):
    df = spark.range(3_000).selectExpr("concat('k', id) AS k")
    assert rows(dense_ids(df, "k")) == rows(dense_ids(df, "k", per_bucket=0.01))
    assert [bucket_digits(n) for n in (0, 10**9, 10**10, 10**12)] == [3, 3, 4, 6]
