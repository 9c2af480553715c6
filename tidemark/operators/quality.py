"""Profiling datasets and checking them against expectations.

All expectations of a dataset are evaluated by one aggregation over it, and one more
plan per column with quantile checks; the report is a small DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ValidationFailed
from tidemark.functions.columns import orderable, q
from tidemark.functions.times import is_time, utc_text
from tidemark.operators.latest import latest_per_key
from tidemark.operators.quantiles import exact_quantiles

# Names of the checks: fixed values.
VALUES_BETWEEN = "expect_column_values_to_be_between"
VALUES_IN_SET = "expect_column_values_to_be_in_set"
VALUES_NOT_NULL = "expect_column_values_to_not_be_null"
VALUES_IN_TYPES = "expect_column_values_to_be_in_type_list"
MEAN_BETWEEN = "expect_column_mean_to_be_between"
MIN_BETWEEN = "expect_column_min_to_be_between"
MAX_BETWEEN = "expect_column_max_to_be_between"
QUANTILES_BETWEEN = "expect_column_quantile_values_to_be_between"


@dataclass(frozen=True)
class Expectation:
    """One check on one column; ``params`` are plain JSON values."""

    check: str
    column: str
    params: dict[str, Any] = field(default_factory=dict)

    @property
    def config(self) -> str:
        return json.dumps({"column": self.column, **self.params}, sort_keys=True)


def values_between(column: str, low=None, high=None, mostly: float = 1.0) -> Expectation:
    """At least ``mostly`` of the non-null values lie in the closed range."""
    return Expectation(VALUES_BETWEEN, column, {"min": low, "max": high, "mostly": mostly})


def values_in_set(column: str, values, mostly: float = 1.0) -> Expectation:
    return Expectation(VALUES_IN_SET, column, {"values": sorted(values), "mostly": mostly})


def values_not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(VALUES_NOT_NULL, column, {"mostly": mostly})


def values_in_types(column: str, types) -> Expectation:
    """The column has one of the given Spark types."""
    return Expectation(VALUES_IN_TYPES, column, {"types": sorted(types)})


def mean_between(column: str, low=None, high=None) -> Expectation:
    return Expectation(MEAN_BETWEEN, column, {"min": low, "max": high})


def min_between(column: str, low=None, high=None) -> Expectation:
    return Expectation(MIN_BETWEEN, column, {"min": low, "max": high})


def max_between(column: str, low=None, high=None) -> Expectation:
    return Expectation(MAX_BETWEEN, column, {"min": low, "max": high})


def quantiles_between(column: str, quantiles: list[float], ranges: list[tuple]) -> Expectation:
    """Each quantile lies in its closed range; None leaves an end open."""
    if len(quantiles) != len(ranges):
        raise ValueError("one range per quantile is needed")
    params = {"quantiles": list(quantiles), "ranges": [list(r) for r in ranges]}
    return Expectation(QUANTILES_BETWEEN, column, params)


REPORT_SCHEMA = (
    "position int, check_name string, column_name string, check_config string, "
    "success boolean, observed double, unexpected_count bigint, missing_count bigint, "
    "missing_percent double"
)


def prepared(df: DataFrame) -> DataFrame:
    """Times as ISO text and floats as doubles, the form checks are written against."""
    changed: dict[str, Column] = {}
    for f in df.schema:
        if is_time(f.dataType):
            changed[f.name] = F.substring(F.replace(utc_text(q(f.name), f.dataType), F.lit(" "), F.lit("T")), 1, 19)
        elif isinstance(f.dataType, T.FloatType):
            changed[f.name] = q(f.name).cast("double")
    return df.withColumns(changed) if changed else df


def report(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """One row per expectation, in order of ``position``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    df = prepared(df)
    numbered = list(enumerate(expectations))
    if not numbered:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    stats: dict[str, Column] = {"__ft_n": F.count(F.lit(1))}
    probabilities: dict[str, dict[float, int]] = {}
    for i, e in numbered:
        stats.setdefault(f"__ft_present_{e.column}", F.count(q(e.column)))
        for name, stat in _stats(e).items():
            stats[f"__ft_{i}_{name}"] = stat
        if e.check == QUANTILES_BETWEEN:
            wanted = probabilities.setdefault(e.column, {})
            for p in e.params["quantiles"]:
                wanted.setdefault(p, len(wanted))
    # A single row, and a single row more per column with quantile checks.
    totals = df.agg(*[c.alias(n) for n, c in stats.items()])
    for k, (column, wanted) in enumerate(probabilities.items()):
        found = exact_quantiles(df, column, list(wanted)).withColumnRenamed("quantiles", f"__ft_quantiles_{k}")
        totals = totals.join(F.broadcast(found), F.lit(True), "left")
    places = {c: (f"__ft_quantiles_{k}", wanted) for k, (c, wanted) in enumerate(probabilities.items())}
    results = [
        _quantile_result(i, e, *places[e.column]) if e.check == QUANTILES_BETWEEN else _result(i, e, types)
        for i, e in numbered
    ]
    return totals.select(F.inline(F.array(*results)))


def failures(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    return report(df, expectations).filter(~F.col("success"))


def validate(df: DataFrame, expectations: list[Expectation]) -> None:
    """Raise :class:`ValidationFailed` with the failed checks, if there are any."""
    failed = failures(df, expectations).orderBy("position").collect()
    if failed:
        raise ValidationFailed(failed)


def _stats(e: Expectation) -> dict[str, Column]:
    """The aggregates an expectation needs."""
    column, p = q(e.column), e.params
    if e.check == VALUES_BETWEEN:
        return {"bad": F.count_if(~_between(column, p["min"], p["max"]))}
    if e.check == VALUES_IN_SET:
        return {"bad": F.count_if(~column.isin(p["values"]))}
    if e.check == VALUES_NOT_NULL:
        return {"bad": F.count_if(column.isNull())}
    if e.check == MEAN_BETWEEN:
        return {"value": F.avg(column)}
    if e.check == MIN_BETWEEN:
        return {"value": F.min(column)}
    if e.check == MAX_BETWEEN:
        return {"value": F.max(column)}
    if e.check in (VALUES_IN_TYPES, QUANTILES_BETWEEN):
        return {}
    raise ValueError(f"unknown check {e.check!r}")


def _between(column: Column, low, high) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (column >= F.lit(low))
    if high is not None:
        ok = ok & (column <= F.lit(high))
    return ok


def _result(i: int, e: Expectation, types: dict[str, str]) -> Column:
    """The report row of one expectation, from the aggregated row."""
    n, present = q("__ft_n"), q(f"__ft_present_{e.column}")
    unexpected = observed = F.lit(None)
    if e.check in (VALUES_BETWEEN, VALUES_IN_SET, VALUES_NOT_NULL):
        unexpected = q(f"__ft_{i}_bad")
        judged = n if e.check == VALUES_NOT_NULL else present
        share = 1 - unexpected / F.nullif(judged, F.lit(0))
        observed = F.coalesce(share, F.lit(1.0))
        success = observed >= F.lit(float(e.params["mostly"]))
    elif e.check == VALUES_IN_TYPES:
        success = F.lit(types[e.column] in e.params["types"])
    else:
        value = q(f"__ft_{i}_value")
        observed = value.try_cast("double")
        success = value.isNotNull() & _between(value, e.params["min"], e.params["max"])
    return _row(i, e, success, observed, unexpected, n, present)


def _row(i, e: Expectation, success, observed, unexpected, n, present) -> Column:
    missing = n - present
    percent = F.coalesce(100.0 * missing / F.nullif(n, F.lit(0)), F.lit(0.0))
    return F.struct(
        F.lit(i).alias("position"),
        F.lit(e.check).alias("check_name"),
        F.lit(e.column).alias("column_name"),
        F.lit(e.config).alias("check_config"),
        F.coalesce(success, F.lit(False)).alias("success"),
        observed.cast("double").alias("observed"),
        unexpected.cast("bigint").alias("unexpected_count"),
        missing.cast("bigint").alias("missing_count"),
        percent.cast("double").alias("missing_percent"),
    )


def _quantile_result(i: int, e: Expectation, column: str, places: dict[float, int]) -> Column:
    """The report row of a quantile check, from the aggregated row."""
    bad = F.lit(0)
    for p, (low, high) in zip(e.params["quantiles"], e.params["ranges"]):
        value = F.get(q(column), F.lit(places[p]))
        ok = value.isNotNull() & _between(value, low, high)
        bad = bad + F.when(ok, 0).otherwise(1)
    return _row(i, e, bad == 0, F.lit(None), bad, q("__ft_n"), q(f"__ft_present_{e.column}"))


# -- profiles -------------------------------------------------------------------

Profiler = Callable[[DataFrame], list[Expectation]]


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: rows, nulls, approximate distinct count, extremes, and the mean of numbers.

    ``min_value`` and ``max_value`` are numbers as doubles; ``min_text`` and ``max_text`` are the
    extremes of any column that has an order, in its own type, as text.
    """
    columns = columns or df.columns
    stats: list[Column] = [F.count(F.lit(1)).alias("__ft_n")]
    for i, c in enumerate(columns):
        number = _is_number(df.schema[c].dataType)
        as_double = q(c).cast("double") if number else F.lit(None).cast("double")
        stats += [
            F.count(q(c)).alias(f"__ft_{i}_present"),
            F.min(as_double).alias(f"__ft_{i}_min"),
            F.max(as_double).alias(f"__ft_{i}_max"),
            F.avg(as_double).alias(f"__ft_{i}_mean"),
            F.approx_count_distinct(q(c)).alias(f"__ft_{i}_distinct"),
        ]
        ordered = orderable(df.schema[c].dataType)
        for end, extreme in (("low", F.min), ("high", F.max)):
            stats.append((extreme(q(c)).cast("string") if ordered else F.lit(None).cast("string")).alias(f"__ft_{i}_{end}"))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            q("__ft_n").alias("row_count"),
            (q("__ft_n") - q(f"__ft_{i}_present")).alias("null_count"),
            q(f"__ft_{i}_distinct").alias("distinct_estimate"),
            q(f"__ft_{i}_min").alias("min_value"),
            q(f"__ft_{i}_max").alias("max_value"),
            q(f"__ft_{i}_mean").alias("mean_value"),
            q(f"__ft_{i}_low").alias("min_text"),
            q(f"__ft_{i}_high").alias("max_text"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*stats).select(F.inline(F.array(*rows)))


MOST_VALUES = 1000


def value_set(df: DataFrame, column: str, most: int = MOST_VALUES) -> list:
    """The distinct values of a column but null; raises if there are more than ``most``."""
    found = df.select(q(column)).filter(q(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"column {column!r} holds more than {most} values")
    return [r[0] for r in found]


def few_valued(df: DataFrame, most: int = 20) -> list[str]:
    """Columns of text, whole numbers or truth values that hold few values, by one pass of sketches.

    The sketch may err by some percent; ``value_set`` is exact about the rest.
    """
    kinds = (T.StringType, T.IntegralType, T.BooleanType)
    columns = [c for c in df.columns if isinstance(df.schema[c].dataType, kinds)]
    if not columns:
        return []
    counts = df.agg(*[F.approx_count_distinct(q(c), 0.02).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] <= most]


def auto_profile(df: DataFrame, set_columns: list[str] | str = ()) -> list[Expectation]:
    """Expectations any similar dataset should meet, generated from ``df``.

    Types always; no nulls where there are none; the value set of the columns in
    ``set_columns``, of which the caller knows that they hold few values, or of all that do
    with "few"; the range of all other numbers and times.  One job, and one more for each
    value set, which may hold ``MOST_VALUES`` values.
    """
    set_columns = few_valued(df) if set_columns == "few" else list(set_columns)
    types = {f.name: f.dataType for f in df.schema}
    df = prepared(df)
    ranged = [c for c in df.columns if c not in set_columns and (_is_number(types[c]) or is_time(types[c]))]
    stats = [F.count(F.lit(1)).alias("__ft_n")]
    for i, c in enumerate(df.columns):
        stats.append(F.count(q(c)).alias(f"__ft_{i}_present"))
        if c in ranged:
            stats += [F.min(q(c)).alias(f"__ft_{i}_min"), F.max(q(c)).alias(f"__ft_{i}_max")]
    totals = df.agg(*stats).first()
    sets = {c: value_set(df, c) for c in set_columns}
    found: list[Expectation] = []
    for i, c in enumerate(df.columns):
        found.append(values_in_types(c, [types[c].simpleString()]))
        if totals[f"__ft_{i}_present"] == totals["__ft_n"]:
            found.append(values_not_null(c))
        if sets.get(c):
            found.append(values_in_set(c, sets[c]))
        elif c in ranged and totals[f"__ft_{i}_min"] is not None:
            low, high = (_plain(totals[f"__ft_{i}_{end}"]) for end in ("min", "max"))
            found.append(values_between(c, low, high))
    return found


def _plain(value):
    """A value JSON can hold."""
    return float(value) if isinstance(value, Decimal) else value


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def consistency_report(
    training: DataFrame, looked_up: DataFrame, keys: list[str], features: list[str]
) -> DataFrame:
    """Per feature: training rows, those whose two values differ, and those not looked up.

    Null equals null; a row whose key was never looked up is missing, not different.
    Repeated lookups of a key are taken together first, so that the join never multiplies
    rows.
    """
    looked_up = looked_up.select(*[q(c) for c in [*keys, *features]])
    looked_up = latest_per_key(looked_up, keys, [])
    renamed = looked_up.select(
        *[q(k) for k in keys],
        *[q(f).alias(f"__ft_other_{f}") for f in features],
        F.lit(True).alias("__ft_found"),
    )
    given = training.select(*[q(k) for k in keys], *[q(f) for f in features])
    both = given.join(renamed, keys, "left")
    found = F.coalesce(q("__ft_found"), F.lit(False))
    counts = [F.count(F.lit(1)).alias("__ft_n"), F.count_if(~found).alias("__ft_missing")]
    for f in features:
        differs = found & ~q(f).eqNullSafe(q(f"__ft_other_{f}"))
        counts.append(F.count_if(differs).alias(f"__ft_bad_{f}"))
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            q("__ft_n").alias("compared"),
            q(f"__ft_bad_{f}").alias("different"),
            q("__ft_missing").alias("missing"),
        )
        for f in features
    ]
    return both.agg(*counts).select(F.inline(F.array(*rows)))
