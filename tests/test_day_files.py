"""Folders of days and months, written by as many tasks as their rows need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from workloads.training import _in_day_files


@pytest.fixture
def small_parts(spark):
    """Adaptive execution with parts of 64 KB."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "64k")
    yield
    spark.conf.unset(name)


def test_one_month_is_not_written_by_one_task(spark, tmp_path, small_parts):
    rows = spark.range(300_000, numPartitions=8).select("id", F.lit("2024-01").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    folder = str(tmp_path / "months")
    _in_day_files(rows).write.partitionBy("day").parquet(folder)
    # a task writes one file of its rows of a month
    assert len(list((tmp_path / "months" / "day=2024-01").glob("*.parquet"))) > 4
    assert spark.read.parquet(folder).agg(F.count("id"), F.countDistinct("x")).first()[:] == (300_000, 300_000)
