"""Spines made of every entity at regular points in time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_not_null, q
from tidemark.functions.times import time_literal
from tidemark.sources.batch import in_time_range


def spine_grid(
    df: DataFrame,
    keys: list[str],
    ts: str,
    start: datetime,
    end: datetime,
    step: timedelta,
    name: str = "event_timestamp",
) -> DataFrame:
    """Each key seen in the range, once per step from ``start`` up to ``end``.

    The grid is the same literal sequence for every key, so it is expanded in place.
    """
    dtype = df.schema[ts].dataType
    seen = in_time_range(df, ts, start, end).filter(all_not_null(keys))
    points = F.sequence(time_literal(start, dtype), time_literal(end, dtype), F.lit(step))
    return (
        seen.select(*[q(k) for k in keys])
        .distinct()
        .select(*[q(k) for k in keys], F.explode(points).alias(name))
    )
