"""Status of a looked-up value."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import time_literal

PRESENT = "PRESENT"
NULL_VALUE = "NULL_VALUE"
NOT_FOUND = "NOT_FOUND"
OUTSIDE_MAX_AGE = "OUTSIDE_MAX_AGE"


def value_status(
    value: Column,
    event_time: Column,
    event_type: T.DataType,
    ttl: timedelta | None,
    now: datetime,
) -> Column:
    """Status of one value.  Being too old takes precedence over being null."""
    status = F.when(event_time.isNull(), F.lit(NOT_FOUND))
    if ttl:
        oldest = time_literal(now, event_type) - F.lit(ttl)
        status = status.when(event_time < oldest, F.lit(OUTSIDE_MAX_AGE))
    return status.when(value.isNull(), F.lit(NULL_VALUE)).otherwise(F.lit(PRESENT))
