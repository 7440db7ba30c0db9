import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from staypath.schema import EVENT_SCHEMA  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01 UTC


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


DEFAULTS = {
    "userId": "1", "auth": "Logged In", "gender": "M", "location": "Town, NY", "userAgent": "Mozilla/5.0",
    "registration": START - 10 * DAY, "level": "free", "ts": START, "sessionId": 1, "itemInSession": 0,
    "page": "Home", "artist": None, "song": None, "length": None,
}


@pytest.fixture(scope="session")
def make_log(spark):
    """Event log from dicts that name only what differs from a plain logged-in event."""
    def make(*rows):
        full = [DEFAULTS | row for row in rows]
        return spark.createDataFrame([[r[f.name] for f in EVENT_SCHEMA] for r in full], EVENT_SCHEMA)
    return make


def by_user(df):
    return {row["userId"]: row.asDict() for row in df.collect()}
