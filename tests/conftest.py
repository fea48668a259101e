import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillroll.schemas import PAYMENT, TRANSACTION, TRUCK, Star  # noqa: E402
from tillroll.sources import Lake, new_folder  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    return Lake(new_folder(spark, "lake"))


@pytest.fixture
def sf_dir():
    return SMALL


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def facts(spark):
    """A fact from (id, truck, method, pence, time) tuples, times as ISO text."""

    def make(*rows):
        typed = [(*row[:4], at(row[4]) if row[4] else None) for row in rows]
        return spark.createDataFrame(typed, TRANSACTION)

    return make


@pytest.fixture
def fleet(spark, facts):
    """A star around the given sales, with trucks A, B, C, and one without a name."""

    def make(*rows):
        trucks = [(1, "A", 1, 4), (2, "B", 0, 5), (3, "C", 1, 3), (4, None, 1, 1)]
        payments = [(1, "cash"), (2, "card")]
        return Star(
            facts(*rows),
            spark.createDataFrame(payments, PAYMENT),
            spark.createDataFrame(trucks, TRUCK),
        )

    return make


def rows(df):
    return [tuple(r) for r in df.collect()]
