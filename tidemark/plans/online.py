"""Bulk lookups: requests joined to the snapshot of each view, with a status per value."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.definitions import DUMMY_KEY, DUMMY_VALUE, Entity, FeatureView
from tidemark.functions.columns import q
from tidemark.functions.status import value_status
from tidemark.functions.times import align
from tidemark.operators.latest import CREATED_TS, EVENT_TS, REMOVED_AT
from tidemark.operators.lookup import lookup, request_keys
from tidemark.plans.historical import check_names, finish, join_keys
from tidemark.plans.resolve import Request, check_request_data, view_key
from tidemark.plans.sizes import Limits, is_small
from tidemark.snapshots import Snapshots
from tidemark.sources.spine import require_columns

STATUS = "__status"
EVENT_TIME = "__event_timestamp"
_ORDER = "__ft_order"


def entity_columns(requests: DataFrame, entities: dict[str, Entity]) -> DataFrame:
    """Requests may name an entity instead of its join key."""
    rename = {
        e.name: e.join_key
        for e in entities.values()
        if e.name != e.join_key and e.name in requests.columns and e.join_key not in requests.columns
    }
    return requests.withColumnsRenamed(rename) if rename else requests


def online(
    requests: DataFrame,
    request: Request,
    entities: dict[str, Entity],
    snapshots: Snapshots,
    now: datetime,
    metadata: bool,
    key_ttl: timedelta | None,
    limits: Limits,
    ordered: bool = False,
) -> DataFrame:
    """The requests with feature values and, with ``metadata``, status and event time."""
    requests = entity_columns(requests, entities)
    check_request_data(request, requests.columns)
    check_names(request, requests, (STATUS, EVENT_TIME) if metadata else ())
    if ordered:
        numbered = requests.withColumn(_ORDER, F.monotonically_increasing_id())
        found = online(numbered, request, entities, snapshots, now, metadata, key_ttl, limits)
        return found.orderBy(_ORDER).drop(_ORDER)
    needed: set[str] = set()
    for item in request.fetched:
        needed.update(r for r, _ in join_keys(item.view, entities))
    require_columns(requests, needed)

    joined = requests
    structs: dict[tuple, str] = {}
    few = is_small(limits, requests)
    for i, item in enumerate(request.fetched):
        name = structs[view_key(item.view)] = f"__ft_v{i}"
        keys = list(join_keys(item.view, entities))
        stored_keys = [s for _, s in keys] or [DUMMY_KEY]
        only = request_keys(requests, keys) if few and keys else None
        found = snapshots.read(item.view.name, stored_keys, only, limits, key_ttl, now)
        rows = _columns(joined, found, item.view, list(item.names), keys)
        joined = lookup(joined, rows, keys, name)

    def feature_column(view: FeatureView, feature: str) -> Column:
        return q(structs[view_key(view)]).getField(feature)

    if not metadata:
        return finish(joined, requests.columns, request, feature_column)
    extra: dict[str, Column] = {}
    for view, feature, output in request.outputs():
        if not isinstance(view, FeatureView):
            continue
        name = structs[view_key(view)]
        event = q(name).getField(EVENT_TS)
        dtype = joined.schema[name].dataType[EVENT_TS].dataType
        value = q(name).getField(feature)
        extra[output + STATUS] = value_status(value, event, dtype, view.ttl, now)
        extra[output + EVENT_TIME] = event
    joined = joined.withColumns(extra) if extra else joined
    result = finish(joined, [*requests.columns, *extra], request, feature_column)
    # Request columns, then each feature followed by its status and event time.
    order = list(requests.columns)
    for _, _, output in request.outputs():
        order += [c for c in (output, output + STATUS, output + EVENT_TIME) if c in result.columns]
    return result.select(*[q(c) for c in dict.fromkeys(order)])


def _columns(
    requests: DataFrame,
    found: DataFrame | None,
    view: FeatureView,
    names: list[str],
    keys: list[tuple[str, str]],
) -> DataFrame:
    """The snapshot columns a lookup needs; an empty table if nothing was loaded."""
    if found is None:
        types = {f.name: f.dtype for f in view.features}
        fields = [T.StructField(s, requests.schema[r].dataType) for r, s in keys]
        fields += [T.StructField(n, types[n]) for n in names]
        fields += [T.StructField(EVENT_TS, T.TimestampNTZType())]
        return requests.sparkSession.createDataFrame([], T.StructType(fields))
    return found.select(*[q(s) for _, s in keys], *[q(n) for n in names], q(EVENT_TS))


def snapshot_rows(
    df: DataFrame, keys: list[str], values: list[str], ts: str, created: str | None
) -> DataFrame:
    """Feature rows in the layout of a snapshot; views without keys get the fixed one.

    A row with ``REMOVED_AT`` ends its key at that time.
    """
    key_columns = [q(k) for k in keys] or [F.lit(DUMMY_VALUE).alias(DUMMY_KEY)]
    # Snapshot times are zone-less UTC, so that loads from different sources compare.
    utc = T.TimestampNTZType()
    event = align(q(ts), df.schema[ts].dataType, utc)
    stamp = align(q(created), df.schema[created].dataType, utc) if created else F.lit(None).cast(utc)
    ended = [q(REMOVED_AT).cast(utc).alias(REMOVED_AT)] if REMOVED_AT in df.columns else []
    event = F.coalesce(*ended, event)
    return df.select(
        *key_columns, *[q(v) for v in values], event.alias(EVENT_TS), stamp.alias(CREATED_TS), *ended
    )
