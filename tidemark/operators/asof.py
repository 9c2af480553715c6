"""Point-in-time (as-of) left join.

For every spine row: the latest feature row of the same key with
``ts - ttl <= event time <= ts``.  Among rows of one event time the latest created
time wins, and among those the greatest feature values, so results never depend on
row order.  Spine rows without a match stay, with a null struct.

Shape of the plan
-----------------
Spine and feature rows are unioned and one window per key set carries the last
feature row forward.  Feature tables that share their join keys travel through the
same shuffle.  That costs one shuffle and one sort per distinct key set, and never
forms (spine row, feature row) pairs.

Large inputs are first searched for hot keys.  A hot key is cut into time slices of
about equal row counts; the last feature row before each slice is copied into it (at
most one row per hot key, slice and feature table), so that every slice can be filled
on its own.  Where many rows share a single event time, the join runs on the distinct
(key, time) points and its result is joined back to the spine, an equi join that
adaptive execution splits when skewed.  Tables without keys are cut by time in the
same way.

Where a large spine has few (key, time) points, such as nations and days, the points are
joined and sent to all tasks, and the spine itself is not shuffled.  All that is asked of a
large spine beforehand is asked of its key and time columns, which are stored meanwhile:
a spine made by joins is worked out once for that, however many key sets there are.

Feature rows of keys that no spine row has are left out before the shuffle
(``plans/keys.py``) where the feature tables are not small.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import all_not_null, orderable, q
from tidemark.functions.times import age_limit, align, is_time
from tidemark.operators.latest import latest_per_key
from tidemark.plans.keys import few_points, key_filter
from tidemark.plans.sizes import DEFAULT_LIMITS, Limits, is_small
from tidemark.plans.skew import LAST, RANK, Skew, cut_time_line, find_skew, ranked, with_slice

# Internal columns; the prefix keeps them clear of user columns.
_TS = "__ft_ts"
_FLAG = "__ft_flag"
_CREATED = "__ft_created"
_SLICE = "__ft_slice"
_FEATURE, _SPINE = 0, 1

EVENT_TIME = "event_timestamp"

PLANS = ("auto", "window", "sliced", "points")


@dataclass(frozen=True)
class AsofSide:
    """One feature table in an as-of join.

    ``keys`` pairs spine columns with feature columns; no pairs means the table has
    one global time line.  The join adds one struct column called ``name`` holding
    ``event_timestamp`` (unless ``timed`` is off) and the ``values``.
    """

    name: str
    df: DataFrame
    ts: str
    values: tuple[str, ...]
    keys: tuple[tuple[str, str], ...] = ()
    created: str | None = None
    ttl: timedelta | None = None
    timed: bool = True


@contextmanager
def looked_at(spine: DataFrame, columns: list[str], limits: Limits, *others: DataFrame) -> Iterator[DataFrame]:
    """Some columns of the spine, stored for as long as a plan is made unless all inputs are small."""
    looked = spine.select(*[q(c) for c in dict.fromkeys(columns)])
    level = looked.storageLevel
    if level.useMemory or level.useDisk or is_small(limits, spine, *others):
        yield looked
        return
    looked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield looked
    finally:
        looked.unpersist()


def asof_join(
    spine: DataFrame,
    ts: str,
    sides: list[AsofSide],
    plan: str = "auto",
    limits: Limits = DEFAULT_LIMITS,
    prune_keys: bool | str = "auto",
    looked: DataFrame | None = None,
) -> DataFrame:
    """Add one struct column per side to ``spine``.

    ``plan`` is one of ``PLANS``; all give the same rows.  ``prune_keys`` leaves out feature
    rows of keys the spine does not have, which takes a job over its key columns; "auto"
    does so when the feature tables are not small.  ``looked`` is what ``looked_at`` gives
    for the spine's time and keys, where at hand.
    """
    if plan not in PLANS:
        raise ValueError(f"plan must be one of {PLANS}, not {plan!r}")
    groups: dict[tuple, list[AsofSide]] = {}
    for side in sides:
        ordered = tuple(sorted(side.keys))
        spine_keys = tuple(s for s, _ in ordered)
        groups.setdefault((spine_keys, _created_type(side)), []).append(side)
    if looked is None:
        columns = [ts, *[s for spine_keys, _ in groups for s in spine_keys]]
        with looked_at(spine, columns, limits, *[s.df for s in sides]) as looked:
            return asof_join(spine, ts, sides, plan, limits, prune_keys, looked)
    out = spine
    for (spine_keys, _), members in groups.items():
        out = _join_group(out, spine, looked, ts, spine_keys, members, plan, limits, prune_keys)
    return out.select(*[q(c) for c in spine.columns], *[q(s.name) for s in sides])


def _created_type(side: AsofSide) -> str | None:
    """Kind of the created column; only tables of one kind can share a sort order."""
    if side.created is None:
        return None
    dtype = side.df.schema[side.created].dataType
    return "time" if is_time(dtype) else dtype.simpleString()


def _join_group(
    spine: DataFrame,
    given: DataFrame,
    looked: DataFrame,
    ts: str,
    spine_keys: tuple[str, ...],
    sides: list[AsofSide],
    plan: str,
    limits: Limits,
    prune_keys: bool | str,
) -> DataFrame:
    """Join the sides that share their keys.

    ``spine`` may already carry the structs of other sides; ``given`` is the caller's
    spine, and ``looked`` its time and keys, which are cheaper to look at.
    """
    keys = _key_types(spine, spine_keys, sides)
    features = [_feature_rows(side, keys, spine.schema[ts].dataType) for side in sides]
    if prune_keys == "auto":
        prune_keys = not is_small(limits, *[s.df for s in sides])
    if prune_keys and keys:
        asked = looked.filter(all_not_null([ts])).select(*[q(s).cast(keys[k]).alias(k) for s, k in zip(spine_keys, keys)])
        wanted = key_filter(asked, list(keys), limits)
        features = [wanted.keep(f) for f in features] if wanted else features
    if plan == "points":
        return _join_points(spine, ts, spine_keys, keys, features, sides, None)
    skew = points = None
    if _may_be_skewed(plan, keys, limits, given, sides):
        if plan == "auto" and keys:
            points = few_points(looked, [ts, *spine_keys], limits)
        asked = looked if points is None else points
        both = _spine_rows(asked, ts, spine_keys, keys).select(*keys, _TS)
        for feature in features:
            both = both.unionByName(feature.select(*keys, _TS))
        if keys:
            skew = find_skew(both, list(keys), _TS, limits)
        else:
            skew = cut_time_line(both, _TS, limits)
        if points is not None or skew is not None and skew.tied:
            return _join_points(spine, ts, spine_keys, keys, features, sides, skew, points)
    return _fill(spine, ts, spine_keys, keys, features, sides, skew)


def _may_be_skewed(plan, keys, limits: Limits, spine: DataFrame, sides: list[AsofSide]) -> bool:
    if plan != "auto":
        return plan == "sliced"
    return not keys or not is_small(limits, spine, *[s.df for s in sides])


def _key_types(
    spine: DataFrame, spine_keys: tuple[str, ...], sides: list[AsofSide]
) -> dict[str, T.DataType]:
    """Internal key columns and the types in which all tables compare their keys."""
    names = [f"__ft_k{i}" for i in range(len(spine_keys))]
    tables = [spine.select(*[q(s).alias(n) for s, n in zip(spine_keys, names)])]
    for side in sides:
        tables.append(side.df.select(*[q(f).alias(n) for (_, f), n in zip(sorted(side.keys), names)]))
    return {f.name: f.dataType for f in reduce(DataFrame.union, tables).schema}


def _time_type(dtype: T.DataType) -> T.DataType:
    """Type in which times are compared: dates count as their first moment."""
    return T.TimestampNTZType() if isinstance(dtype, T.DateType) else dtype


def _spine_rows(
    spine: DataFrame, ts: str, spine_keys: tuple[str, ...], keys: dict[str, T.DataType]
) -> DataFrame:
    """Key, time and flag of the spine rows, and those columns they cannot be read off."""
    dtype = spine.schema[ts].dataType
    restored = _restored(spine, ts, spine_keys, keys)
    return spine.select(
        *[q(s).cast(keys[k]).alias(k) for s, k in zip(spine_keys, keys)],
        align(q(ts), dtype, _time_type(dtype)).alias(_TS),
        F.lit(_SPINE).alias(_FLAG),
        *[q(c) for c in spine.columns if c not in restored],
    )


def _restored(
    spine: DataFrame, ts: str, spine_keys: tuple[str, ...], keys: dict[str, T.DataType]
) -> dict[str, str]:
    """Spine columns that equal an internal column, so need not be carried twice."""
    same = {s: k for s, k in zip(spine_keys, keys) if spine.schema[s].dataType == keys[k]}
    if not isinstance(spine.schema[ts].dataType, T.DateType):
        same[ts] = _TS
    return same


def _feature_rows(side: AsofSide, keys: dict[str, T.DataType], spine_time) -> DataFrame:
    """Feature rows in the layout of the union; rows that can never match are left out."""
    schema = side.df.schema
    spine_time = _time_type(spine_time)
    event = align(q(side.ts), schema[side.ts].dataType, spine_time)
    columns = [q(f).cast(keys[k]).alias(k) for (_, f), k in zip(sorted(side.keys), keys)]
    columns += [event.alias(_TS), F.lit(_FEATURE).alias(_FLAG)]
    if side.created is not None:
        created = q(side.created)
        if is_time(schema[side.created].dataType):
            created = align(created, schema[side.created].dataType, spine_time)
        columns.append(created.alias(_CREATED))
    hit = F.struct(event.alias(EVENT_TIME), *[q(v) for v in side.values])
    columns.append(hit.alias(side.name))
    usable = all_not_null([side.ts, *[f for _, f in side.keys]])
    return side.df.filter(usable).select(*columns)


def _sort_order(df: DataFrame, sides: list[AsofSide]) -> list[Column]:
    """Order inside a group: time, features before spine rows, created, then values."""
    order = [q(c) for c in (_TS, _FLAG, *_recency(df, _CREATED))]
    for side in sides:
        # The struct as a whole where possible: one sort column however many features.
        dtype = df.schema[side.name].dataType
        if orderable(dtype):
            order.append(q(side.name))
        else:
            known = [f.name for f in dtype.fields if orderable(f.dataType)]
            order.append(F.struct(*[q(side.name).getField(n) for n in known]))
    return order


def _fill(
    spine: DataFrame,
    ts: str,
    spine_keys: tuple[str, ...],
    key_types: dict[str, T.DataType],
    features: list[DataFrame],
    sides: list[AsofSide],
    skew: Skew | None,
) -> DataFrame:
    """Union everything, carry the last feature row forward, keep the spine rows."""
    keys = list(key_types)
    rows = _spine_rows(spine, ts, spine_keys, key_types)
    restored = _restored(spine, ts, spine_keys, key_types)
    if skew is None:
        rows = rows.withColumn(_SLICE, F.lit(-1))
        features = [f.withColumn(_SLICE, F.lit(-1)) for f in features]
    else:
        rows = _assign_slice(rows, keys, skew)
        features = [_with_carry(f, keys, side, skew) for f, side in zip(features, sides)]
    union = _spread_unmatched(rows, keys)
    for feature in features:
        union = union.unionByName(feature, allowMissingColumns=True)

    window = (
        Window.partitionBy(*keys, _SLICE)
        .orderBy(*_sort_order(union, sides))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # The struct is what counts as null or not, so a null feature value of the latest
    # row stays null instead of falling back to an older row.
    filled = union.withColumns(
        {s.name: F.last(q(s.name), ignorenulls=True).over(window) for s in sides}
    ).filter(q(_FLAG) == _SPINE)
    # Only feature rows up to the spine row's time come before it; their age is left.
    hits = []
    for s in sides:
        fresh = q(s.name).getField(EVENT_TIME) >= age_limit(q(_TS), s.ttl) if s.ttl else q(s.name).isNotNull()
        hit = q(s.name) if s.timed else F.struct(*[q(s.name).getField(v).alias(v) for v in s.values])
        hits.append(F.when(fresh, hit).alias(s.name))
    return filled.select(*[q(restored.get(c, c)).alias(c) for c in spine.columns], *hits)


def _spread_unmatched(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Give spine rows with a null key or time, which match nothing, slices of their own.

    They get the number of the partition that read them, so that many of them do not
    end up in one group.  The number is the same when a lost task is run again.
    """
    known = F.when(all_not_null([*keys, _TS]), q(_SLICE))
    return rows.withColumn(_SLICE, known.otherwise(-2 - F.spark_partition_id()))


def _assign_slice(df: DataFrame, keys: list[str], skew: Skew) -> DataFrame:
    """Slice number for hot keys, -1 for all others."""
    return with_slice(df, keys, _TS, skew, _SLICE)


def _with_carry(df: DataFrame, keys: list[str], side: AsofSide, skew: Skew) -> DataFrame:
    """Feature rows with their slice, plus the last row before each slice of a hot key."""
    sliced = _assign_slice(df, keys, skew)
    if skew.slices == 1:
        return sliced
    hot = sliced.filter(q(_SLICE) >= 0)
    last = latest_per_key(hot, [*keys, _SLICE], _recency(hot, _TS, _CREATED))
    # One row per hot key and slice by now, so this window stays small.
    following = F.lead(_SLICE).over(Window.partitionBy(*keys).orderBy(_SLICE))
    carried = ranked(last.withColumn("__ft_next", following), keys, skew)
    carried = carried.withColumn("__ft_to", F.coalesce("__ft_next", LAST)).drop(RANK, LAST)
    if side.ttl:
        carried = carried.withColumn("__ft_exp", q(_TS) + F.lit(side.ttl))
        carried = with_slice(carried, keys, "__ft_exp", skew, "__ft_end")
        carried = carried.withColumn("__ft_to", F.least("__ft_to", "__ft_end"))
    carried = (
        carried.filter(q(_SLICE) < q("__ft_to"))
        .withColumn(_SLICE, F.explode(F.sequence(q(_SLICE) + 1, q("__ft_to"))))
        .select(*sliced.columns)
    )
    return sliced.unionByName(carried)


def _join_points(
    spine: DataFrame,
    ts: str,
    spine_keys: tuple[str, ...],
    keys: dict[str, T.DataType],
    features: list[DataFrame],
    sides: list[AsofSide],
    skew: Skew | None,
    few: DataFrame | None = None,
) -> DataFrame:
    """As-of join of the distinct (key, time) points, joined back on those columns.

    ``few`` holds the points where they are few enough to be sent to all tasks.
    """
    point_ts = "__ft_pt"
    point_keys = [f"__ft_p{i}" for i in range(len(spine_keys))]
    named = [*[q(s).alias(p) for s, p in zip(spine_keys, point_keys)], q(ts).alias(point_ts)]
    if few is None:
        points = spine.filter(all_not_null([ts, *spine_keys])).select(*named).distinct()
    else:
        points = few.select(*named)
    features = [latest_per_key(rows, [*keys, _TS], _recency(rows, _CREATED)) for rows in features]
    hits = _fill(points, point_ts, tuple(point_keys), keys, features, sides, skew)
    condition = q(ts) == q(point_ts)
    for s, p in zip(spine_keys, point_keys):
        condition = condition & (q(s) == q(p))
    # ``few`` has at most ``2 * few_points`` rows
    joined = spine.join(hits if few is None else F.broadcast(hits), condition, "left")
    return joined.select(*[q(c) for c in spine.columns], *[q(s.name) for s in sides])


def _recency(rows: DataFrame, *columns: str) -> list[str]:
    return [c for c in columns if c in rows.columns]
