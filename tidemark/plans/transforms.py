"""Applying on-demand views to rows that already carry their inputs."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.definitions import Feature, OnDemandView
from tidemark.errors import FeatureNotFound, InferenceError
from tidemark.functions.columns import q


def input_columns(view: OnDemandView, feature_column, request_columns: dict[str, T.DataType]):
    """Inputs by name; features appear as ``feature`` and as ``view__feature``."""
    inputs: dict[str, Column] = {}
    for source in view.input_views:
        for feature in source.projected:
            column = feature_column(source, feature.name)
            inputs[feature.name] = column
            inputs[f"{source.name_to_use}__{feature.name}"] = column
    for name, dtype in request_columns.items():
        inputs[name] = q(name).cast(dtype)
    return inputs


def with_on_demand(
    df: DataFrame, view: OnDemandView, inputs: dict[str, Column], prefix: str
) -> tuple[DataFrame, dict[str, Column]]:
    """Add the view's features under internal names; returns where to find each of them."""
    if view.mode == "columns":
        result = view.fn(inputs)
        names = {f.name: f"{prefix}_{i}" for i, f in enumerate(view.features)}
        added = {names[f.name]: result[f.name].cast(f.dtype) for f in view.features}
        return df.withColumns(added), {n: q(internal) for n, internal in names.items()}
    fn = view.fn
    names = [f.name for f in view.features]
    schema = T.StructType([T.StructField(f.name, f.dtype) for f in view.features])

    def transform(rows: pd.DataFrame) -> pd.DataFrame:
        # A copy, since user functions often add columns to the frame they are given.
        return fn(rows.copy())[names].reset_index(drop=True)

    transform.__annotations__ = {"rows": pd.DataFrame, "return": pd.DataFrame}
    # Declared non-deterministic so that it is evaluated once, where it stands, and the
    # optimizer does not reason about its many inputs one by one.
    apply = F.pandas_udf(transform, returnType=schema).asNondeterministic()
    packed = F.struct(*[c.alias(n) for n, c in inputs.items()])
    return df.withColumn(prefix, apply(packed)), {n: q(prefix).getField(n) for n in names}


def inferred(spark: SparkSession, view: OnDemandView) -> tuple[Feature, ...]:
    """Output features of a view, from a run on no rows; checks declared ones.

    No job runs: column functions are analysed, pandas functions see an empty frame.
    """
    fields: dict[str, T.DataType] = {}
    for source in view.input_views:
        for feature in source.projected:
            fields[feature.name] = feature.dtype
            fields[f"{source.name_to_use}__{feature.name}"] = feature.dtype
    fields.update(view.request_schema())
    schema = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    empty = spark.createDataFrame([], schema)
    if view.mode == "columns":
        result = view.fn({n: q(n) for n in fields})
        found = empty.select(*[c.alias(n) for n, c in result.items()]).schema
    else:
        frame = pd.DataFrame({f.name: pd.Series(dtype=_pandas_type(f.dataType)) for f in schema})
        found = from_arrow_schema(pa.Schema.from_pandas(view.fn(frame), preserve_index=False))
    if not found.names:
        raise InferenceError(f"on-demand view {view.name!r} returns no columns")
    if view.features:
        missing = [f.name for f in view.features if f.name not in found.names]
        if missing:
            raise FeatureNotFound(f"on-demand view {view.name!r} does not return {missing}")
        return view.features
    untyped = [f.name for f in found if isinstance(f.dataType, T.NullType)]
    if untyped:
        raise InferenceError(f"on-demand view {view.name!r}: declare the types of {untyped}")
    return tuple(Feature(f.name, f.dataType) for f in found)


def _pandas_type(dtype: T.DataType) -> str:
    """Dtype of an empty pandas column standing for a Spark type."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime64[ns]"
    names = {"int": "int32", "bigint": "int64", "float": "float32", "double": "float64"}
    names["boolean"] = "bool"
    return names.get(dtype.simpleString(), "object")
