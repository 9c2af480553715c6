"""The caller's rows that features are joined onto."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import MissingSpineColumns
from tidemark.functions.times import is_time
from tidemark.sources.inference import single_time_column

DEFAULT_TIME = "event_timestamp"


def as_spine(spark: SparkSession, rows: DataFrame | pd.DataFrame | str) -> DataFrame:
    """Spine from a DataFrame, a pandas frame (through Arrow) or SQL text."""
    if isinstance(rows, str):
        return spark.sql(rows)
    if isinstance(rows, pd.DataFrame):
        return spark.createDataFrame(_utc(rows))
    return rows


def _utc(rows: pd.DataFrame) -> pd.DataFrame:
    """Pandas times to zoned UTC, so that the session's zone plays no part."""
    zoned = rows.select_dtypes(include=["datetimetz"]).columns
    naive = rows.select_dtypes(include=["datetime"]).columns
    changed = {c: rows[c].dt.tz_convert("UTC") for c in zoned}
    changed.update({c: rows[c].dt.tz_localize("UTC") for c in naive})
    return rows.assign(**changed)


def infer_spine_time(spine: DataFrame) -> str:
    """``event_timestamp`` if there is one, else the only time column."""
    if DEFAULT_TIME in spine.columns and is_time(spine.schema[DEFAULT_TIME].dataType):
        return DEFAULT_TIME
    return single_time_column(spine.schema)


def require_columns(spine: DataFrame, needed: set[str]) -> None:
    missing = needed - set(spine.columns)
    if missing:
        raise MissingSpineColumns(f"the spine lacks columns {sorted(missing)}")
