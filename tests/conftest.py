import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .appName("evenbasket-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s


D = dt.date

# Golden hand example F3 (FIXTURES.md): N = 2, weekend 01-04/05, C has no bar on 01-06.
F3_ROWS = [
    (D(2025, 1, 2), "A", 10.0, 100),
    (D(2025, 1, 2), "B", 20.0, 40),
    (D(2025, 1, 2), "C", 5.0, 100),
    (D(2025, 1, 3), "A", 12.5, 100),
    (D(2025, 1, 3), "B", 19.0, 20),
    (D(2025, 1, 3), "C", 5.5, 100),
    (D(2025, 1, 6), "A", 12.5, 100),
    (D(2025, 1, 6), "B", 22.0, 40),
    (D(2025, 1, 7), "A", 12.5, 100),
    (D(2025, 1, 7), "B", 22.0, 40),
    (D(2025, 1, 7), "C", 6.0, 100),
]


def make_bars(spark, rows):
    """(date, ticker, close, volume) rows -> stock_data-shaped DataFrame."""
    df = spark.createDataFrame(rows, "date date, ticker string, close double, volume long")
    return df.select(
        "date",
        "ticker",
        F.col("close").alias("open"),
        F.col("close").alias("high"),
        F.col("close").alias("low"),
        "close",
        "volume",
        (F.col("close") * F.col("volume")).alias("market_cap"),
    )


@pytest.fixture(scope="session")
def f3_bars(spark):
    return make_bars(spark, F3_ROWS)
