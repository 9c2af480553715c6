"""Small helpers for building column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> Column:
    """A top-level column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort and compare values of this type."""
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def orderable_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given columns that can take part in an ORDER BY."""
    return [n for n in names if orderable(df.schema[n].dataType)]


def all_not_null(names: Iterable[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & q(name).isNotNull()
    return condition
