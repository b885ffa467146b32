import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from barloom.schema import configure  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("barloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


BAR_DDL = (
    "Stock string, Date timestamp, Open double, High double, Low double, Close double, "
    "Volume double"
)


@pytest.fixture
def make_bars(spark):
    """Bars from ``[(symbol, day offset, close), ...]``; day 0 is 1970-01-01."""

    def make(rows):
        full = []
        for symbol, day, close in rows:
            date = datetime(1970, 1, 1) + timedelta(days=day)
            full.append(
                (symbol, date, close - 1.0, close + 2.0, close - 3.0, close, 100.0 + day % 7)
            )
        return spark.createDataFrame(full, BAR_DDL)

    return make
