"""Declared value types and casts to them."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import TypeMismatch
from tidemark.functions.columns import q


class ValueType(Enum):
    """The value types a feature or entity can be declared with.

    Fixed values: eight scalars and a one-level list of each.
    """

    BYTES = T.BinaryType()
    STRING = T.StringType()
    INT32 = T.IntegerType()
    INT64 = T.LongType()
    DOUBLE = T.DoubleType()
    FLOAT = T.FloatType()
    BOOL = T.BooleanType()
    UNIX_TIMESTAMP = T.TimestampType()
    BYTES_LIST = T.ArrayType(T.BinaryType())
    STRING_LIST = T.ArrayType(T.StringType())
    INT32_LIST = T.ArrayType(T.IntegerType())
    INT64_LIST = T.ArrayType(T.LongType())
    DOUBLE_LIST = T.ArrayType(T.DoubleType())
    FLOAT_LIST = T.ArrayType(T.FloatType())
    BOOL_LIST = T.ArrayType(T.BooleanType())
    UNIX_TIMESTAMP_LIST = T.ArrayType(T.TimestampType())


_BY_NAME = {v.value.simpleString(): v.value for v in ValueType}


def spark_type(declared: ValueType | T.DataType | str) -> T.DataType:
    """A declared type as a Spark type; unknown or untyped declarations are rejected.

    The names of the value types work without a session, other type names need one.
    """
    if isinstance(declared, ValueType):
        return declared.value
    if isinstance(declared, str):
        declared = _BY_NAME.get(declared) or T.DataType.fromDDL(declared)
    if isinstance(declared, T.NullType):
        raise TypeMismatch("a feature or entity needs a concrete type")
    return declared


# Widening steps that lose nothing, as (from, to) pairs of Spark type names.
_WIDER = {
    ("tinyint", "int"),
    ("smallint", "int"),
    ("tinyint", "bigint"),
    ("smallint", "bigint"),
    ("int", "bigint"),
    ("float", "double"),
    ("int", "double"),
    ("timestamp_ntz", "timestamp"),
    ("date", "timestamp"),
}


def fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether a column of type ``have`` can serve where ``want`` was declared."""
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return fits(have.elementType, want.elementType)
    names = (have.simpleString(), want.simpleString())
    return names[0] == names[1] or names in _WIDER


def castable(have: T.DataType, want: T.DataType) -> bool:
    """Whether rows handed in with type ``have`` may be cast to the declared ``want``.

    Numbers of one family may narrow; a value that does not fit then fails the job.
    """
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return castable(have.elementType, want.elementType)
    families = (T.IntegralType, T.FractionalType)
    return fits(have, want) or any(isinstance(have, f) and isinstance(want, f) for f in families)


def to_declared(df: DataFrame, declared: dict[str, T.DataType], where: str) -> DataFrame:
    """Cast columns to their declared types; raises if a type contradicts its declaration."""
    wrong = [n for n, t in declared.items() if not castable(df.schema[n].dataType, t)]
    if wrong:
        have = {n: df.schema[n].dataType.simpleString() for n in wrong}
        raise TypeMismatch(f"{where}: {have} do not fit the declared types")
    return df.withColumns(
        {n: q(n).cast(t) for n, t in declared.items() if df.schema[n].dataType != t}
    )


def check_declared(df: DataFrame, declared: dict[str, T.DataType], where: str) -> None:
    """Raise if a column's type contradicts its declaration.  Reads only the schema."""
    wrong = [
        f"{name}: {df.schema[name].dataType.simpleString()}, declared {want.simpleString()}"
        for name, want in declared.items()
        if name in df.columns and not fits(df.schema[name].dataType, want)
    ]
    if wrong:
        raise TypeMismatch(f"{where}: " + "; ".join(wrong))


def try_cast(col: Column, dtype: T.DataType) -> Column:
    """Cast; values that do not fit become null instead of failing the job."""
    return col.try_cast(dtype)


def cast_declared(df: DataFrame, declared: dict[str, T.DataType]) -> DataFrame:
    """Cast the declared columns, with null for values that do not fit."""
    return df.withColumns(
        {n: try_cast(q(n), t) for n, t in declared.items() if n in df.columns}
    )


def cast_failures(df: DataFrame, declared: dict[str, T.DataType]) -> DataFrame:
    """One row: per declared column, how many non-null values the cast would lose."""
    return df.agg(
        *[
            F.count_if(q(n).isNotNull() & try_cast(q(n), t).isNull()).alias(n)
            for n, t in declared.items()
        ]
    )
