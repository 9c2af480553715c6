"""Cutting lineage with tables written to the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_folder, with_local_scratch


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one; a session on one machine gets one where none is set."""
    return shared_folder(with_local_scratch(spark), purpose)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written once as Parquet and read back; a lost executor loses none of them."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
