"""Time handling.  A timestamp without a zone always means UTC."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "1970-01-01 00:00:00"

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, TIME_TYPES)


def to_utc(moment: datetime) -> datetime:
    """Python datetime as a naive UTC one."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def time_literal(moment: datetime | date, dtype: T.DataType) -> Column:
    """A literal of exactly ``dtype``.

    Matching the column's own type keeps Catalyst from wrapping the column in a
    cast, so that a comparison with the literal still reaches the Parquet scan.
    """
    if not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    text = to_utc(moment).isoformat(sep=" ", timespec="microseconds")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return F.lit(text[:10]).cast("date")
    return F.lit(text + "+00:00").cast("timestamp")


def epoch_seconds(col: Column, dtype: T.DataType) -> Column:
    """Seconds since 1970 in UTC as a double; never decreases as time goes on.

    Zone-less values are taken apart field by field, because casting them would
    bend the time line at the daylight-saving changes of the session's zone.
    """
    if isinstance(dtype, T.TimestampType):
        return col.cast("double")
    days = F.unix_date(col.cast("date")).cast("double") * 86400
    if isinstance(dtype, T.DateType):
        return days
    seconds = F.extract(F.lit("SECOND"), col).cast("double")
    return days + F.hour(col) * 3600 + F.minute(col) * 60 + seconds


def align(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """Bring a time column to another time type, reading zone-less values as UTC."""
    if have == want:
        return col
    if isinstance(have, T.DateType):
        return align(col.cast("timestamp_ntz"), T.TimestampNTZType(), want)
    if isinstance(have, T.TimestampNTZType) and isinstance(want, T.TimestampType):
        whole = (
            F.unix_date(col.cast("date")).cast("long") * 86400
            + F.hour(col) * 3600
            + F.minute(col) * 60
        )
        micros = (F.extract(F.lit("SECOND"), col) * 1000000).cast("long")
        return F.timestamp_micros(whole * 1000000 + micros)
    if isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        seconds = (F.unix_micros(col).cast("decimal(24,0)") / 1000000).cast("decimal(18,6)")
        zero = F.lit(0)
        return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    raise TypeError(f"cannot align {have.simpleString()} with {want.simpleString()}")


def utc_text(col: Column, dtype: T.DataType) -> Column:
    """ISO text of a time in UTC, whatever the session's zone."""
    return align(col, dtype, T.TimestampNTZType()).cast("string")


def in_zone(col: Column, zone: str) -> Column:
    """Wall-clock time of ``zone`` (zone-less) to UTC wall-clock time (zone-less)."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col)


def age_limit(ts: Column, ttl: timedelta) -> Column:
    """Oldest event time still allowed for a row asked for at ``ts``."""
    return ts - F.lit(ttl)


def seconds_of(col: Column) -> Column:
    """Whole seconds since 1970 of a zoned timestamp; fractions are cut off."""
    return F.unix_seconds(col)


def from_seconds(col: Column) -> Column:
    return F.timestamp_seconds(col)
