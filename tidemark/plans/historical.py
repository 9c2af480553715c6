"""Building training sets: one as-of join per distinct key set, then the transforms."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.carry import Carry
from tidemark.definitions import Entity, FeatureView, OnDemandView, RequestView
from tidemark.errors import FeatureNameCollision, TidemarkError
from tidemark.functions.columns import q
from tidemark.functions.times import time_literal, utc_text
from tidemark.operators.asof import AsofSide, asof_join, looked_at
from tidemark.plans.resolve import Request, Wanted, check_request_data, view_key
from tidemark.plans.sizes import Limits, is_small
from tidemark.plans.transforms import input_columns, with_on_demand
from tidemark.sources.batch import BatchSource
from tidemark.sources.spine import require_columns


def join_keys(view: FeatureView, entities: dict[str, Entity]) -> tuple[tuple[str, str], ...]:
    """(spine or request column, source column) per entity of the view."""
    keys = [entities[name].join_key for name in view.entities]
    return tuple((view.join_key_map.get(k, k), k) for k in keys)


def time_span(df: DataFrame, ts: str) -> tuple[datetime | None, datetime | None]:
    """Earliest and latest time as naive UTC, in one job over the time column."""
    dtype = df.schema[ts].dataType
    row = df.agg(*[utc_text(bound(q(ts)), dtype) for bound in (F.min, F.max)]).first()
    return tuple(None if v is None else datetime.fromisoformat(v) for v in row)


def historical(
    spark: SparkSession,
    spine: DataFrame,
    ts: str,
    request: Request,
    entities: dict[str, Entity],
    plan: str,
    prune: bool | str,
    limits: Limits,
    prune_keys: bool | str = "auto",
    carry: Carry | None = None,
) -> DataFrame:
    """The spine with the requested features as further columns.

    With ``prune`` the sources are cut to the time span the spine can match; that takes
    one job over the spine's time column.  With ``prune_keys`` they are cut to its keys.
    "auto" does so when a source is not small.  With ``carry`` sources are read from its cut
    on, and no row of the spine may lie before it.
    """
    check_request_data(request, spine.columns)
    check_names(request, spine)
    needed = [ts, *[s for item in request.fetched for s, _ in join_keys(item.view, entities)]]
    require_columns(spine, set(needed))

    structs = {view_key(item.view): f"__ft_v{i}" for i, item in enumerate(request.fetched)}
    joined = spine
    if request.fetched:
        sources = [item.view.source.read(spark) for item in request.fetched]
        with looked_at(spine, needed, limits, *sources) as looked:
            lo = hi = None
            if prune == "auto":
                prune = not is_small(limits, *sources)
            if prune or carry:
                lo, hi = time_span(looked, ts)
                if carry and lo is not None and lo < carry.at:
                    raise TidemarkError(f"rows from {lo} on, before the cut {carry.at} of carry {carry.name!r}")
            sides = []
            for item, rows in zip(request.fetched, sources):
                keys = join_keys(item.view, entities)
                sides.append(_side(spark, structs[view_key(item.view)], item, keys, rows, lo, hi, carry))
            joined = asof_join(spine, ts, sides, plan, limits, prune_keys, looked)

    def feature_column(view: FeatureView, feature: str) -> Column:
        return q(structs[view_key(view)]).getField(feature)

    return finish(joined, spine.columns, request, feature_column)


def finish(
    joined: DataFrame, keep: list[str], request: Request, feature_column
) -> DataFrame:
    """Apply on-demand views and select the requested outputs."""
    transformed: dict[str, dict[str, Column]] = {}
    for i, item in enumerate(request.on_demand()):
        inputs = input_columns(item.view, feature_column, item.view.request_schema())
        joined, found = with_on_demand(joined, item.view, inputs, f"__ft_t{i}")
        transformed[item.view.name_to_use] = found

    outputs: list[Column] = []
    for view, feature, output in request.outputs():
        if isinstance(view, RequestView):
            if output != feature:
                outputs.append(q(feature).alias(output))
        elif isinstance(view, OnDemandView):
            outputs.append(transformed[view.name_to_use][feature].alias(output))
        else:
            outputs.append(feature_column(view, feature).alias(output))
    return joined.select(*[q(c) for c in keep], *outputs)


def check_names(request: Request, given: DataFrame, suffixes: tuple[str, ...] = ()) -> None:
    """Raise if an output, or one with a suffix, has the name of a given column."""
    have = set(given.columns)
    taken = [
        output + suffix
        for view, _, output in request.outputs()
        for suffix in ("", *suffixes)
        if not isinstance(view, RequestView) and output + suffix in have
    ]
    if taken:
        raise FeatureNameCollision(f"the given rows already have columns {taken}")


def after(spark: SparkSession, source: BatchSource, cut: datetime, end: datetime | None = None, rows=None) -> DataFrame:
    """Rows of a source later than ``cut``, up to ``end``."""
    df = source.load(spark, cut, end, rows=rows)
    ts = source.mapped(source.event_timestamp_column)
    return df.filter(q(ts) > time_literal(cut, df.schema[ts].dataType))


def carried(spark: SparkSession, carry: Carry, view: str, later: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of a carry and those after its cut."""
    names = [q(c) for c in columns]
    return carry.rows(spark, view).select(*names).unionByName(later.select(*names))


def _side(
    spark: SparkSession,
    name: str,
    item: Wanted,
    keys: tuple[tuple[str, str], ...],
    rows: DataFrame,
    lo: datetime | None,
    hi: datetime | None,
    carry: Carry | None,
) -> AsofSide:
    """One view's part in the join, cut to what the spine can match."""
    view, source = item.view, item.view.source
    oldest = lo - view.ttl if lo is not None and view.ttl else None
    ts = source.mapped(source.event_timestamp_column)
    created = source.mapped(source.created_timestamp_column)
    if carry is None:
        df = source.load(spark, oldest, hi, rows=rows)
    else:
        used = dict.fromkeys([*[s for _, s in keys], ts, *([created] if created else []), *item.names])
        df = carried(spark, carry, view.name, after(spark, source, carry.at, hi, rows), list(used))
    return AsofSide(
        name=name,
        df=df,
        ts=ts,
        created=created,
        values=tuple(item.names),
        keys=keys,
        ttl=view.ttl or None,
        timed=False,
    )
