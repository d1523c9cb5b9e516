import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


def own_queries():
    """Registered queries but those of the optional subpackage, which has its own tests."""
    import __spark_entry__ as contract

    return {k: v for k, v in contract.queries().items() if not re.match(r"op\d+_|pipeline$", k)}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ridemetrics-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """For stored tables."""
    return tmp_path.as_uri()


@pytest.fixture
def many_parts(spark):
    """Sorted parts small enough that AQE would otherwise merge them into one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
