import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF_DIR


@pytest.fixture
def run(tmp_path):
    from tidemark.model import Run

    return Run(datetime(2024, 5, 1, 10, 20, 30), str(tmp_path / "lake"))


@pytest.fixture
def customers(spark, sf):
    return spark.read.parquet(f"{sf}/customer.parquet")


def plan_of(df):
    return df._jdf.queryExecution().toString()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
