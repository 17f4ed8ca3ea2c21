import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark import Grid  # noqa: E402
from tidemark import schemas as S  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
DAY = datetime(2023, 2, 2)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def grid():
    return Grid()


@pytest.fixture
def make_bars(spark):
    """Bars from (symbol, minutes after DAY, price) with optional high, low and coins."""

    def make(rows, coins=1000.0):
        records = []
        for symbol, minute, price, *more in rows:
            high, low = more[:2] if more else (price, price)
            traded = more[2] if len(more) > 2 else coins
            at = DAY + timedelta(minutes=minute)
            records.append(
                (symbol, at, at.date(), price, high, low, price)
                + (price * traded, traded, traded / 2, price * traded / 2, 5)
            )
        return spark.createDataFrame(records, S.BARS)

    return make


@pytest.fixture
def make_targets(spark):
    """Targets from (name, symbol, minutes after DAY) with an optional value."""

    def make(rows):
        records = []
        for name, symbol, minute, *value in rows:
            at = DAY + timedelta(minutes=minute)
            records.append((name, symbol, at.date(), at, value[0] if value else 1.5))
        return spark.createDataFrame(records, S.TARGETS)

    return make


@pytest.fixture
def make_case(spark):
    """Rows of one case from (offset, low, average, high), entered at ``entry``."""
    schema = T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("part_name", T.DateType()),
            T.StructField("target_timestamp", T.TimestampNTZType()),
            T.StructField("offset", T.IntegerType()),
            T.StructField("interval_id", T.IntegerType()),
            T.StructField(S.LOW, T.DoubleType()),
            T.StructField(S.AVG, T.DoubleType()),
            T.StructField(S.HIGH, T.DoubleType()),
            T.StructField(S.USD, T.DoubleType()),
            T.StructField("price_in", T.DoubleType()),
        ]
    )

    def make(rows, entry=100.0, usd=1.0):
        records = [
            ("A", DAY.date(), DAY, off, min(max(off, -1), 2))
            + (float(low), float(avg), float(high), float(usd), float(entry))
            for off, low, avg, high in rows
        ]
        return spark.createDataFrame(records, schema)

    return make
