import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def new_york(spark):
    """The session in a zone with daylight saving."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


EVENT_SCHEMA = (
    "event_id string, event_type string, user_id string, session_id string, product_id string, "
    "event_timestamp timestamp_ntz"
)


@pytest.fixture
def make_events(spark):
    def make(rows, schema=EVENT_SCHEMA):
        return spark.createDataFrame(rows, schema)

    return make
