import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def schema(spark):
    """A fresh schema in the shared folder."""
    from modelloom.shared import scratch_schema

    return scratch_schema(spark, "test")


@pytest.fixture
def rows():
    """A frame's rows as sorted tuples."""

    def collect(df, *columns):
        return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)

    return collect


def pytest_collection_modifyitems(items):
    # functions defined in test modules travel to the Python workers by value
    for module in {item.module for item in items}:
        cloudpickle.register_pickle_by_value(module)
