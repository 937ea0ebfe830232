"""Schemas of the inputs and results. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields.items()])


# Heights are numbers here: as strings '99' would sort above '181'.
PEOPLE = _struct(id=StringType, gender=StringType, height=DoubleType)

USERS = _struct(
    user_id=StringType,
    gender=StringType,
    age=IntegerType,
    register_date=StringType,
    role=StringType,
    region=StringType,
)

# Dates come unpadded (2015-1-5) and stay strings; functions.fields.unpadded_date types them.
PURCHASES = _struct(
    order_id=StringType,
    order_date=StringType,
    product_id=IntegerType,
    price=IntegerType,
    user_id=StringType,
)

HOUSE = _struct(client=StringType, city=StringType, keyword=StringType, area=StringType)

ACCESS_LOG = _struct(log_time=StringType, ip=StringType, cookie_id=StringType)

SEARCH = _struct(name=StringType, item=StringType)

# click_count is read as a double because producers send both 5 and 5.0.
CLICK_JSON = _struct(
    uid=StringType, event_time=StringType, os_type=StringType, click_count=StringType
)

PREFS = _struct(user_id=StringType, item_id=StringType, pref=DoubleType)

SIMS = _struct(item_id1=StringType, item_id2=StringType, similar=DoubleType)

RATINGS = _struct(user_id=StringType, movie_id=IntegerType, rating=DoubleType)

MOVIES = _struct(movie_id=IntegerType, score=DoubleType, title=StringType)

COUNTS = _struct(key=StringType, total=LongType)
