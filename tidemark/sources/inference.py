"""Filling in what a definition leaves out, from column names and types only."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.errors import InferenceError
from tidemark.functions.times import is_time


def single_time_column(schema: T.StructType) -> str:
    """The only time column; none or several is an error."""
    found = [f.name for f in schema if is_time(f.dataType)]
    if len(found) != 1:
        raise InferenceError(f"need exactly one time column to infer from, found {found}")
    return found[0]


def entity_type(schema: T.StructType, join_key: str) -> T.DataType:
    """Type of an entity from the join key column."""
    if join_key not in schema.names:
        raise InferenceError(f"no column {join_key!r} to infer the entity type from")
    return schema[join_key].dataType


def feature_columns(schema: T.StructType, roles: set[str]) -> list[T.StructField]:
    """Columns that are features: not in ``roles`` and without ``__`` at either end."""
    found = [
        f
        for f in schema
        if f.name not in roles and not f.name.startswith("__") and not f.name.endswith("__")
    ]
    if not found:
        raise InferenceError("no feature columns left after keys and times")
    return found
