import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemill.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="1000",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture
def lines(spark):
    """DataFrame of text lines."""

    def make(*values, column="line"):
        return spark.createDataFrame([(v,) for v in values], f"{column} string")

    return make


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples."""

    def make(df, *columns):
        return sorted(
            (tuple(r) for r in (df.select(*columns) if columns else df).collect()),
            key=lambda t: tuple((x is not None, x) for x in t),
        )

    return make
