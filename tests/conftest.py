import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="reelhouse-test-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("reelhouse-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="reelhouse-case-")


@pytest.fixture()
def fresh_layers(spark):
    """No tables in the three layers, before the test and after it."""

    def drop():
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")

    drop()
    yield
    drop()
