import pytest

from tidemill import schemas
from tidemill.functions.fields import unpadded_date
from tidemill.operators import purchases as b
from tidemill.operators.traffic import column_stats, sum_by_key
from tidemill.plans import reports


def test_people_from_text(spark, tmp_path, rows):
    (tmp_path / "people").write_text("1 M 181\n2 F 99\n3 M 180.5\n4 F 171\n")
    report = reports.people_from_text(spark, str(tmp_path / "people"))
    assert rows(report["men_above_180"]) == [(2,)]
    assert rows(report["women_above_170"]) == [(1,)]
    assert rows(report["by_gender"]) == [("F", 2), ("M", 2)]
    assert rows(report["men_above_210"]) == []
    assert [r.id for r in report["tallest"].collect()] == ["1", "3", "4", "2"]
    assert report["average_man"].first().avg_height == 180.75
    # Heights compare as numbers: as text, 99 would be the greatest.
    assert report["tallest_woman"].first().max_height == 171


def test_purchases_from_text(spark, tmp_path, rows):
    users = tmp_path / "users"
    users.write_text("1 M 20 2010-1-5 ROLE001 REG001\n10 F 30 2011-2-6 ROLE002 REG002\n")
    orders = tmp_path / "orders"
    orders.write_text(
        "a 2015-1-5 1 100 1\nb 2015-2-1 2 300 1\nc 2014-1-1 3 50 10\nd 2015-3-3 4 70 99\n"
        "e 2014-12-31 5 150 10\n"
    )
    report = reports.purchases_from_text(spark, str(users), str(orders))
    assert rows(report["orders_2015"]) == [(2,)]  # order d's user is unknown
    assert rows(report["buyers_2015"]) == [(1,)]
    assert rows(report["orders_2014"]) == [(2,)]
    assert rows(report["orders_of_user_1"]) == [("a", 1, 100, "1"), ("b", 2, 300, "1")]
    assert rows(report["prices_of_user_10"]) == [(150, 50, 100.0, "10")]
    assert spark.sql("SELECT count(*) FROM orders o, user u WHERE o.userID IS NULL"
                     .replace("o.userID", "o.user_id")).first()[0] == 0


@pytest.fixture
def doubled(spark):
    """A users table that has user 1 twice."""
    users = spark.createDataFrame([("1",), ("1",), ("2",)], "user_id string")
    purchases = spark.createDataFrame(
        [("a", "2015-1-1", 1, 10, "1"), ("b", "2015-1-1", 1, 20, "2"), ("c", "2015-1-1", 1, 1, None)],
        schemas.PURCHASES,
    )
    return users, purchases


def test_repeated_users_repeat_joined_rows(doubled, rows):
    users, purchases = doubled
    assert rows(b.known_purchase_count(purchases, users)) == [(3,)]
    assert rows(b.buyer_count(purchases, users)) == [(2,)]
    assert rows(b.purchases_of(purchases, users, "1"), "order_id") == [("a",), ("a",)]
    assert rows(b.purchases_of(purchases, users, "7")) == []
    assert rows(b.price_stats(purchases, users)) == [(10, 10, 10.0, "1"), (20, 20, 20.0, "2")]


def test_no_purchases_count_as_zero(doubled, rows):
    users, purchases = doubled
    assert rows(b.known_purchase_count(b.dated(purchases, "1999"), users)) == [(0,)]


def test_unpadded_dates(spark):
    df = spark.createDataFrame([("2015-1-5",), ("2015-12-28",)], "d string")
    assert [str(r[0]) for r in df.select(unpadded_date("d")).collect()] == ["2015-01-05", "2015-12-28"]


def test_house_report(spark, tmp_path):
    (tmp_path / "HouseSecond1").write_text(",".join(str(i) for i in range(22)) + "\n1,2\n")
    houses = reports.houses_from_text(spark, f"{tmp_path}/HouseSecond*")["houses"]
    assert [tuple(r) for r in houses.collect()] == [("0", "1", "2", "15")]


def test_statistics_and_sums(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", None)], "k string, v double")
    n, mean, deviation, most, least = column_stats(df, "v").first()
    assert (n, mean, most, least) == (3, 3.0, 5.0, 1.0)
    assert deviation == pytest.approx((8 / 3) ** 0.5)
    assert rows(sum_by_key(df, "k", "v")) == [("a", 4.0), ("b", 5.0)]
