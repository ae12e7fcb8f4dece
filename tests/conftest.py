from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = str(tmp_path_factory.mktemp("checkpoints"))
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", checkpoints)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def accounts(spark):
    from attrition.plans.accounts import accounts

    return accounts(spark, SMALL).cache()


@pytest.fixture(scope="session")
def features(spark):
    """Model input of all sf0.01 accounts that are no outliers."""
    from attrition.plans.catalog import training

    return training(spark, "/root/testdata/sf0.01").cache()
