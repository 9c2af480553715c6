"""Batch sources: files, tables, queries, connectors and DataFrames."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SourceValidationError
from tidemark.functions.columns import q
from tidemark.functions.times import is_time, time_literal
from tidemark.sources.inference import single_time_column


@dataclass(frozen=True, kw_only=True)
class BatchSource:
    """A time-stamped table.

    The column roles name source columns; ``field_mapping`` renames source columns to
    feature names when the source is loaded.
    """

    name: str = ""
    event_timestamp_column: str | None = None
    created_timestamp_column: str | None = None
    field_mapping: dict[str, str] = field(default_factory=dict)
    date_partition_column: str | None = None
    date_partition_format: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as it is, unfiltered and with its own column names."""
        raise NotImplementedError

    def schema(self, spark: SparkSession) -> T.StructType:
        """Column names and types; no job runs."""
        return self.read(spark).schema

    def mapped(self, column: str | None) -> str | None:
        """Name of a source column after the field mapping."""
        return None if column is None else self.field_mapping.get(column, column)

    def resolved(self, spark: SparkSession, needs: list[str] = ()) -> BatchSource:
        """The source with its event-time column filled in.

        Raises unless it can be read and has its declared and needed columns.
        """
        try:
            schema = self.schema(spark)
        except AnalysisException as error:
            raise SourceValidationError(f"source {self.name!r} cannot be read: {error}") from error
        self._check(schema, needs)
        return self._with_schema(schema)

    def _with_schema(self, schema: T.StructType) -> BatchSource:
        if self.event_timestamp_column:
            return self
        return replace(self, event_timestamp_column=single_time_column(schema))

    def _check(self, schema: T.StructType, needs: list[str]) -> None:
        declared = [
            c
            for c in (
                self.event_timestamp_column,
                self.created_timestamp_column,
                self.date_partition_column,
                *self.field_mapping,
            )
            if c
        ]
        back = {new: old for old, new in self.field_mapping.items()}
        missing = {back.get(c, c) for c in (*declared, *needs)} - set(schema.names)
        if missing:
            raise SourceValidationError(f"source {self.name!r} lacks columns {sorted(missing)}")
        if self.date_partition_column:
            check_partition_format(schema[self.date_partition_column].dataType, self.date_partition_format)
        event = self.event_timestamp_column
        if event and not is_time(schema[event].dataType):
            raise SourceValidationError(
                f"source {self.name!r}: event time {event!r} is {schema[event].dataType.simpleString()}"
            )

    def load(
        self,
        spark: SparkSession,
        start: datetime | None = None,
        end: datetime | None = None,
        closed: str = "both",
        rows: DataFrame | None = None,
    ) -> DataFrame:
        """Rows with ``start <= event time <= end``, renamed by the field mapping.

        The bounds are literals of the column's own type, so they reach the scan; with a
        date partition column they also select the partitions to read.  ``closed="left"``
        leaves ``end`` itself out.  ``rows`` is the result of ``read`` where at hand.
        How finely a partition column cuts time is what ``date_partition_format`` says, such
        as "yyyyMMdd" or "yyyy-MM" for text and whole numbers, and likewise for dates.  Without
        it, dates and timestamps may stand for anything from an hour to a quarter, and
        other types select no partitions; so all settings give the same rows.
        """
        df = self.read(spark) if rows is None else rows
        event = self.event_timestamp_column
        if start is not None or end is not None:
            if event is None:
                event = single_time_column(df.schema)
            df = in_time_range(df, event, start, end, closed)
            if self.date_partition_column:
                df = _in_partitions(
                    df, self.date_partition_column, self.date_partition_format, start, end
                )
        if self.field_mapping:
            df = df.withColumnsRenamed(self.field_mapping)
        return df


def in_time_range(
    df: DataFrame,
    ts: str,
    start: datetime | None = None,
    end: datetime | None = None,
    closed: str = "both",
) -> DataFrame:
    """Rows whose time lies in the range; a missing bound is open."""
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    dtype = df.schema[ts].dataType
    if start is not None:
        df = df.filter(q(ts) >= time_literal(start, dtype))
    if end is not None:
        bound = time_literal(end, dtype)
        df = df.filter(q(ts) < bound if closed == "left" else q(ts) <= bound)
    return df


def _in_partitions(
    df: DataFrame,
    column: str,
    pattern: str | None,
    start: datetime | None,
    end: datetime | None,
) -> DataFrame:
    """Restrict a time-partitioned table to the partitions the range touches."""
    dtype = df.schema[column].dataType
    first = None if start is None else time_literal(start, T.DateType())
    last = None if end is None else time_literal(end, T.DateType())
    if is_time(dtype):
        unit = _UNITS.get(re.sub("[^yMd]", "", pattern or ""), "quarter")
        zoned = not isinstance(dtype, T.DateType)
        # Hours of the first and last day, and a day more on either side for zones.
        low = None if first is None else q(column) >= F.date_add(F.date_trunc(unit, first).cast("date"), -zoned)
        high = None if last is None else q(column) < F.date_add(last, 1 + zoned)
    elif pattern is not None:
        low = None if first is None else q(column) >= F.date_format(first, pattern).cast(dtype)
        high = None if last is None else q(column) <= F.date_format(last, pattern).cast(dtype)
    else:
        return df
    for bound in (low, high):
        if bound is not None:
            df = df.filter(bound)
    return df


# Patterns whose text, or number, sorts like the time it stands for.
_SORTABLE = re.compile(r"yyyy(?:[^A-Za-z]?MM(?:[^A-Za-z]?dd)?)?")


_UNITS = {"yyyyMMdd": "day", "yyyyMM": "month", "yyyy": "year"}


def check_partition_format(dtype: T.DataType, pattern: str | None) -> None:
    """Raise unless partitions written in this pattern can be compared in time order."""
    if pattern is None:
        return
    if not is_time(dtype) and not isinstance(dtype, (T.StringType, T.IntegralType)):
        raise SourceValidationError(f"no partition format for {dtype.simpleString()}")
    if not _SORTABLE.fullmatch(pattern) or isinstance(dtype, T.IntegralType) and not pattern.isalpha():
        raise SourceValidationError(f"partitions in the form {pattern!r} do not sort by time")


@dataclass(frozen=True, kw_only=True)
class FileSource(BatchSource):
    """Files in any format Spark reads, local or in an object store."""

    path: str
    file_format: str = "parquet"
    file_schema: str | T.StructType | None = None
    options: dict[str, str] = field(default_factory=dict)
    s3_endpoint_override: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.file_format).options(**self.options)
        if self.s3_endpoint_override:
            reader = reader.option("fs.s3a.endpoint", self.s3_endpoint_override)
        if self.file_schema is not None:
            reader = reader.schema(self.file_schema)
        return reader.load(self.path)

    def _with_schema(self, schema: T.StructType) -> BatchSource:
        # Kept, so that reading the files later needs no look at their footers.
        known = self if self.file_schema is not None else replace(self, file_schema=schema)
        return super(FileSource, known)._with_schema(schema)


@dataclass(frozen=True, kw_only=True)
class TableSource(BatchSource):
    """A table or view of the session's catalogs."""

    table: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


@dataclass(frozen=True, kw_only=True)
class QuerySource(BatchSource):
    """A SQL query, or a function from the session to a DataFrame."""

    query: str | Callable[[SparkSession], DataFrame]

    def read(self, spark: SparkSession) -> DataFrame:
        return self.query(spark) if callable(self.query) else spark.sql(self.query)


@dataclass(frozen=True, kw_only=True)
class FrameSource(BatchSource):
    """A DataFrame the caller already has."""

    df: DataFrame = field(compare=False)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.df


@dataclass(frozen=True, kw_only=True)
class ConnectorSource(BatchSource):
    """A warehouse reached through any installed Spark connector, such as ``jdbc``."""

    format: str
    options: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.format).options(**self.options).load()
