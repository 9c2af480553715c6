from __future__ import annotations

import logging
import tempfile

import pytest
from pyspark.sql import SparkSession


def build_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    logging.getLogger("py4j").setLevel(logging.ERROR)
    return spark


@pytest.fixture(scope="session")
def spark():
    session = build_session()
    yield session
    session.stop()
