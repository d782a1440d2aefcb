import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone with daylight saving: no result may depend on the session zone.
    session = (
        SparkSession.builder.master("local[4]")
        .appName("plumeledger-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as plain tuples; ``sort`` for frames without an order."""

    def collect(df, sort=False):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=repr) if sort else found

    return collect


SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("driver tables not present")
    return SF_DIR


def plan_of(df):
    """The physical plan as text, before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()
