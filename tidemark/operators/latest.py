"""Latest row per key, and merging latest rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import orderable_columns, q
from tidemark.sources.batch import in_time_range

# Bookkeeping columns of a snapshot row.
EVENT_TS = "__event_ts"
CREATED_TS = "__created_ts"
WRITTEN_AT = "__written_at"
# When a key ended; null in rows that hold values.
REMOVED_AT = "__removed_at"

_BEST = "__ft_best"
_STORED = "__ft_stored"


def latest_per_key(df: DataFrame, keys: list[str], recency: list[str]) -> DataFrame:
    """The row with the greatest ``recency`` columns for every key.

    Ties go to the greatest other values, so the result does not depend on row order.
    An aggregate of one struct: every task sends at most one row per key into the
    shuffle, whatever share of the rows a key holds.  Without keys one row comes back
    (none for no input).
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = list(dict.fromkeys([*recency, *orderable_columns(df, rest)]))
    if len(ranked) == len(rest):
        best = F.max(F.struct(*[q(c) for c in ranked]))
    else:
        best = F.max_by(F.struct(*[q(c) for c in rest]), F.struct(*[q(c) for c in ranked]))
    grouped = df.groupBy(*[q(k) for k in keys]).agg(best.alias(_BEST))
    if not keys:
        grouped = grouped.filter(q(_BEST).isNotNull())
    return grouped.select(
        *[q(c) if c in keys else q(_BEST).getField(c).alias(c) for c in df.columns]
    )


def pull_latest(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    ts: str,
    created: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    closed: str = "both",
) -> DataFrame:
    """Latest row per key among the rows of a time range: keys, values, times."""
    times = [ts] if created is None else [ts, created]
    columns = list(dict.fromkeys([*keys, *values, *times]))
    ranged = in_time_range(df, ts, start, end, closed).filter(q(ts).isNotNull())
    return latest_per_key(ranged.select(*[q(c) for c in columns]), keys, times)


def pull_all(
    df: DataFrame,
    columns: list[str],
    ts: str,
    start: datetime | None = None,
    end: datetime | None = None,
    closed: str = "both",
) -> DataFrame:
    """Every row of a time range, duplicates included."""
    return in_time_range(df, ts, start, end, closed).select(*[q(c) for c in columns])


def merge_latest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Snapshot ``old`` with the rows of ``new`` that are strictly newer.

    Newer means a greater (event time, created time); on a tie the stored row stays, so
    replaying rows changes nothing.
    """
    both = old.withColumn(_STORED, F.lit(1)).unionByName(new.withColumn(_STORED, F.lit(0)))
    return latest_per_key(both, keys, [EVENT_TS, CREATED_TS, _STORED]).drop(_STORED)
