import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample():
    return "/root/testdata/sf0.001"


@pytest.fixture
def lines(spark):
    """A DataFrame of text lines."""

    def make(*values):
        return spark.createDataFrame([(value,) for value in values], "value string")

    return make


@pytest.fixture
def corpus(spark):
    """A DataFrame of documents or of lines of documents."""

    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id string, text string")

    return make


@pytest.fixture
def words(spark):
    """A vocabulary or stop list."""

    def make(*values):
        return spark.createDataFrame([(value,) for value in values], "word string")

    return make
