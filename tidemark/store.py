"""The entry point: registered definitions plus the jobs that use them."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from tidemark.carry import Carries, Carry
from tidemark.datasets import (
    FileStorage,
    Reference,
    Retrieval,
    SavedDataset,
    SavedDatasets,
    TableStorage,
)
from tidemark.definitions import (
    DUMMY_KEY,
    AnyView,
    Entity,
    Feature,
    FeatureService,
    FeatureView,
    OnDemandView,
    RequestView,
)
from tidemark.errors import (
    DuplicateName,
    EntityNotFound,
    InferenceError,
    MissingSpineColumns,
    ServiceNotFound,
    SourceValidationError,
    TidemarkError,
    ViewNotFound,
)
from tidemark.functions.columns import all_not_null, q
from tidemark.functions.times import to_utc
from tidemark.functions.types import check_declared, to_declared
from tidemark.operators.latest import CREATED_TS, EVENT_TS, latest_per_key, pull_all, pull_latest
from tidemark.operators.quality import Profiler
from tidemark.plans.historical import after, carried, historical, join_keys
from tidemark.plans.online import online, snapshot_rows
from tidemark.plans.resolve import resolve
from tidemark.plans.sizes import DEFAULT_LIMITS, Limits
from tidemark.plans.transforms import inferred
from tidemark.session import shared_folder
from tidemark.snapshots import Snapshots
from tidemark.sources.batch import BatchSource
from tidemark.sources.inference import entity_type, feature_columns
from tidemark.sources.spine import as_spine, infer_spine_time
from tidemark.sources.streams import PushSource, StreamSource
from tidemark.streaming.expiry import expiring_stream
from tidemark.streaming.push import push_stream

Definition = Entity | AnyView | FeatureService | BatchSource | PushSource


class FeatureStore:
    """Definitions of one project, its snapshots and its saved datasets.

    ``root`` is a folder every executor can reach; without one a folder below
    ``spark.checkpoint.dir`` is used.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        key_ttl: timedelta | None = None,
        limits: Limits = DEFAULT_LIMITS,
    ):
        self.spark = spark
        root = (root or shared_folder(spark, "features")).rstrip("/")
        self.snapshots = Snapshots(spark, f"{root}/snapshots", limits)
        self.datasets = SavedDatasets(spark, f"{root}/datasets")
        self.carries = Carries(spark, f"{root}/carries")
        self.key_ttl = key_ttl
        self.limits = limits
        self._entities: dict[str, Entity] = {}
        self._views: dict[str, AnyView] = {}
        self._services: dict[str, FeatureService] = {}
        self._sources: dict[str, BatchSource | PushSource] = {}

    # -- definitions -----------------------------------------------------------

    def apply(self, *definitions: Definition | list[Definition]) -> None:
        """Register or replace definitions, filling in what can be inferred.

        Reads only schemas.  Entities and plain views come before the views and services
        built on them, in whatever order they are given.
        """
        flat: list[Definition] = []
        for d in definitions:
            flat.extend(d if isinstance(d, (list, tuple)) else [d])
        _reject_duplicates(flat)
        self._reject_case_clashes(flat)
        for d in flat:
            if isinstance(d, (BatchSource, PushSource)):
                self._sources[d.name] = d
        for d in flat:
            if isinstance(d, Entity):
                self._entities[d.name] = d
        for d in flat:
            if isinstance(d, FeatureView):
                self._views[d.name] = self._complete(d)
        for d in flat:
            if isinstance(d, RequestView):
                self._views[d.name] = d
            elif isinstance(d, OnDemandView):
                self._views[d.name] = self._complete_on_demand(d)
        for d in flat:
            if isinstance(d, FeatureService):
                unknown = [v.name for v in d.views if v.name not in self._views]
                if unknown:
                    raise ViewNotFound(f"service {d.name!r} uses unknown views {unknown}")
                self._services[d.name] = d

    def _reject_case_clashes(self, new: list[Definition]) -> None:
        for kind, known in (
            ((FeatureView, RequestView, OnDemandView), self._views),
            ((BatchSource, PushSource), self._sources),
        ):
            by_fold = {n.casefold(): n for n in known}
            for d in new:
                if isinstance(d, kind) and by_fold.get(d.name.casefold(), d.name) != d.name:
                    raise DuplicateName(f"{d.name!r} differs from another name only in case")

    def _complete(self, view: FeatureView) -> FeatureView:
        for name in view.entities:
            if name not in self._entities:
                raise EntityNotFound(f"view {view.name!r} uses unknown entity {name!r}")
        source = view.source
        if source is None and isinstance(view.stream_source, PushSource):
            source = view.stream_source.batch_source
        if source is None:
            if not view.features:
                raise InferenceError(f"view {view.name!r} has neither a source nor features")
            return view
        keys = [self._entities[n].join_key for n in view.entities]
        source = source.resolved(self.spark, [*keys, *[f.name for f in view.features]])
        loaded = source.load(self.spark)
        for name in view.entities:
            entity = self._entities[name]
            if entity.value_type is None:
                found = entity_type(loaded.schema, entity.join_key)
                self._entities[name] = replace(entity, value_type=found)
        check_declared(loaded, {f.name: f.dtype for f in view.features}, f"view {view.name!r}")
        if not view.features:
            roles = {
                *keys,
                source.mapped(source.event_timestamp_column),
                source.mapped(source.created_timestamp_column),
                source.mapped(source.date_partition_column),
            }
            fields = feature_columns(loaded.schema, roles)
            view = replace(view, features=tuple(Feature(f.name, f.dataType) for f in fields))
        return replace(view, source=source)

    def _complete_on_demand(self, view: OnDemandView) -> OnDemandView:
        inputs = []
        for source in view.inputs:
            if isinstance(source, FeatureView):
                known = self._views.get(source.name)
                if known is None:
                    raise ViewNotFound(f"{view.name!r} uses unknown view {source.name!r}")
                source = replace(
                    known,
                    alias=source.alias,
                    selected=source.selected,
                    join_key_map=source.join_key_map,
                )
            inputs.append(source)
        view = replace(view, inputs=tuple(inputs))
        return replace(view, features=inferred(self.spark, view))

    def entity(self, name: str) -> Entity:
        if name not in self._entities:
            raise EntityNotFound(f"no entity {name!r}")
        return self._entities[name]

    def view(self, name: str) -> AnyView:
        if name not in self._views:
            raise ViewNotFound(f"no view {name!r}")
        return self._views[name]

    def service(self, name: str) -> FeatureService:
        if name not in self._services:
            raise ServiceNotFound(f"no feature service {name!r}")
        return self._services[name]

    def source(self, name: str) -> BatchSource | PushSource:
        if name not in self._sources:
            raise TidemarkError(f"no source {name!r}")
        return self._sources[name]

    def entities(self) -> list[Entity]:
        return list(self._entities.values())

    def views(self) -> list[AnyView]:
        return list(self._views.values())

    def services(self) -> list[FeatureService]:
        return list(self._services.values())

    def remove_view(self, name: str) -> None:
        """Unregister a view and forget its snapshot."""
        view = self.view(name)
        del self._views[name]
        if isinstance(view, FeatureView):
            self.snapshots.drop(name)

    def remove_service(self, name: str) -> None:
        self.service(name)
        del self._services[name]

    def drop_unused_snapshots(self) -> list[str]:
        """Forget the snapshots of views that are no longer registered."""
        return self.snapshots.drop_unused(list(self._views))

    # -- training sets -----------------------------------------------------------

    def get_historical_features(
        self,
        entity_df: DataFrame | pd.DataFrame | str,
        features: list[str] | FeatureService,
        full_feature_names: bool = False,
        event_timestamp: str | None = None,
        plan: str = "auto",
        prune: bool | str = "auto",
        prune_keys: bool | str = "auto",
        carry: Carry | None = None,
    ) -> Retrieval:
        """Point-in-time features for every row of ``entity_df``, which keeps its columns.

        ``prune`` and ``prune_keys`` cut the sources to the times and keys of the rows before
        anything is joined, at the cost of a job each; "auto" does so for large sources.
        With a ``carry`` of the views' latest rows the sources are read from its cut on; the
        rows must not lie before it.
        """
        request = resolve(features, self._views, full_feature_names)
        spine = as_spine(self.spark, entity_df)
        ts = event_timestamp or infer_spine_time(spine)
        df = historical(
            self.spark, spine, ts, request, self._entities, plan, prune, self.limits, prune_keys, carry
        )
        keys = {s for item in request.fetched for s, _ in join_keys(item.view, self._entities)}
        return Retrieval(df, tuple(request.refs), tuple(sorted(keys)), ts, full_feature_names)

    def save_carry(self, name: str, cut: datetime, views: list[str] | None = None, since: Carry | None = None) -> Carry:
        """Keep the latest row per key up to ``cut`` of some views, by default all with a source.

        With an earlier carry only the source rows after its cut are read.
        """
        cut = to_utc(cut)
        if since is not None and since.at > cut:
            raise TidemarkError(f"carry {since.name!r} was cut at {since.at}, after {cut}")
        if views is None:
            views = [v.name for v in self._views.values() if isinstance(v, FeatureView) and v.source is not None]
        tables = {}
        for view in map(self._feature_view, views):
            ts, created, keys, values = self._roles(view)
            columns = list(dict.fromkeys([*keys, ts, *([created] if created else []), *values]))
            if since is None:
                rows = view.source.load(self.spark, None, cut).select(*[q(c) for c in columns])
            else:
                rows = carried(self.spark, since, view.name, after(self.spark, view.source, since.at, cut), columns)
            tables[view.name] = pull_latest(rows.filter(all_not_null([*keys, ts])), keys, values, ts, created)
        return self.carries.save(name, cut, tables)

    def get_carry(self, name: str) -> Carry:
        return self.carries.get(name)

    # -- snapshots ---------------------------------------------------------------

    def pull_latest(self, view: str, start: datetime, end: datetime, closed="both") -> DataFrame:
        """Latest source row per entity in a time range."""
        v = self._feature_view(view)
        ts, created, keys, values = self._roles(v)
        return pull_latest(v.source.load(self.spark, start, end, closed), keys, values, ts, created)

    def pull_all(self, view: str, start: datetime, end: datetime, closed="both") -> DataFrame:
        """Every source row in a time range."""
        v = self._feature_view(view)
        ts, created, keys, values = self._roles(v)
        columns = list(dict.fromkeys([*keys, *values, ts, *([created] if created else [])]))
        return pull_all(v.source.load(self.spark, start, end, closed), columns, ts)

    def materialize(
        self,
        start: datetime,
        end: datetime,
        views: list[str] | None = None,
        now: datetime | None = None,
        closed: str = "both",
        missing_only: bool = False,
    ) -> None:
        """Load the latest row per entity between ``start`` and ``end`` into the snapshots.

        With ``missing_only`` only the parts of the range that were never loaded are read.
        """
        if to_utc(start) > to_utc(end):
            raise TidemarkError(f"start {start} is after end {end}")
        for view in self._online_views(views):
            for first, last in self.missing_ranges(view.name, start, end) if missing_only else [(start, end)]:
                self._materialize(view, first, last, now, closed if last == end else "both")

    def missing_ranges(self, view: str, start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
        """The parts of a time range that no load of a view has covered since it was last dropped.

        Both ends belong to each part, so the moments at its ends may have been loaded.
        """
        return self.snapshots.gaps(view, start, end)

    def materialize_incremental(
        self, end: datetime, views: list[str] | None = None, now: datetime | None = None
    ) -> None:
        """Load from where the last load ended, or from ``now - ttl`` if there was none."""
        now = to_utc(now or _utc_now())
        for view in self._online_views(views):
            start = self.snapshots.last_end(view.name)
            if start is None:
                if not view.ttl:
                    raise TidemarkError(
                        f"view {view.name!r} was never loaded and has no ttl to start from"
                    )
                start = now - view.ttl
            if start > to_utc(end):
                raise TidemarkError(f"start {start} is after end {end}")
            self._materialize(view, start, end, now, "both")

    def _materialize(self, view, start, end, now, closed) -> None:
        ts, created, keys, values = self._roles(view)
        df = view.source.load(self.spark, start, end, closed).filter(all_not_null(keys))
        df = to_declared(df, self._declared(view), f"view {view.name!r}")
        rows = snapshot_rows(pull_latest(df, keys, values, ts, created), keys, values, ts, created)
        self.snapshots.add(view.name, rows, to_utc(now or _utc_now()), start, end, keys=keys or [DUMMY_KEY], closed=closed)

    def write_to_online_store(
        self,
        view: str,
        rows: DataFrame | pd.DataFrame,
        now: datetime | None = None,
        version: str | None = None,
    ) -> None:
        """Push feature rows into a view's snapshot; rows that are not newer change nothing.

        Rows with a time in the column ``__removed_at`` end their keys at that time.
        """
        v = self._feature_view(view)
        df = as_spine(self.spark, rows)
        keys = [self._entities[n].join_key for n in v.entities]
        ts, created = self._push_times(v, df)
        values = [f.name for f in v.features]
        missing = {*keys, *values, ts} - set(df.columns)
        if missing:
            raise SourceValidationError(f"pushed rows lack columns {sorted(missing)}")
        df = to_declared(df, self._declared(v), f"view {view!r}").filter(all_not_null([*keys, ts]))
        flat = snapshot_rows(df, keys, values, ts, created)
        stored = keys or [DUMMY_KEY]
        newest = latest_per_key(flat, stored, [EVENT_TS, CREATED_TS])
        self.snapshots.add(view, newest, to_utc(now or _utc_now()), version=version, keys=stored)

    def push(self, source: str, rows: DataFrame | pd.DataFrame, now: datetime | None = None) -> None:
        """Push rows of a push source into every view fed by it."""
        push_source = self.source(source)
        if not isinstance(push_source, PushSource):
            raise TidemarkError(f"{source!r} is not a push source")
        checked = push_source.check(as_spine(self.spark, rows))
        for view in self._views.values():
            if isinstance(view, FeatureView) and view.stream_source == push_source:
                self.write_to_online_store(view.name, checked, now)

    def push_stream(
        self,
        view: str,
        checkpoint: str,
        stream: DataFrame | None = None,
        trigger: dict | None = None,
        now: datetime | None = None,
        key_ttl: timedelta | None = None,
        delay: str = "0 seconds",
    ) -> StreamingQuery:
        """Keep a view's snapshot up to date from a stream, by default its stream source.

        With ``key_ttl`` keys leave the snapshot when the stream's time, less ``delay``, is that
        far past their latest row; rows later than ``delay`` are dropped then.
        """
        if stream is None:
            source = self._feature_view(view).stream_source
            if not isinstance(source, StreamSource):
                raise TidemarkError(f"view {view!r} has no stream source")
            stream = source.read_stream(self.spark)

        def push(batch: DataFrame, version: str) -> None:
            self.write_to_online_store(view, batch, now, version)

        if key_ttl is None:
            return push_stream(stream, push, checkpoint, f"push-{view}", trigger)
        v = self._feature_view(view)
        keys = [self._entities[n].join_key for n in v.entities]
        ts, created = self._push_times(v, stream)
        used = dict.fromkeys([*keys, ts, *([created] if created else []), *[f.name for f in v.features]])
        changes = expiring_stream(stream.select(*[q(c) for c in used]), keys, ts, key_ttl, delay, created)
        return push_stream(changes, push, checkpoint, f"push-{view}", trigger, "update")

    def get_online_features(
        self,
        features: list[str] | FeatureService,
        entity_rows: list[dict[str, Any]] | DataFrame | pd.DataFrame,
        full_feature_names: bool = False,
        now: datetime | None = None,
        metadata: bool = True,
        ordered: bool = False,
    ) -> DataFrame:
        """Latest known features for many entities at once.

        With ``metadata`` each feature is followed by its status and event time.  With
        ``ordered`` the answers come in the order of the requests, by a range sort.
        """
        if isinstance(entity_rows, list):
            if len({frozenset(r) for r in entity_rows}) != 1:
                raise MissingSpineColumns("all entity rows must have the same keys")
            entity_rows = self.spark.createDataFrame(pa.Table.from_pylist(entity_rows))
        requests = as_spine(self.spark, entity_rows)
        request = resolve(features, self._views, full_feature_names)
        return online(
            requests,
            request,
            self._entities,
            self.snapshots,
            to_utc(now or _utc_now()),
            metadata,
            self.key_ttl,
            self.limits,
            ordered,
        )

    # -- saved datasets ------------------------------------------------------------

    def create_saved_dataset(
        self,
        from_: Retrieval,
        name: str,
        storage: FileStorage | TableStorage | None = None,
        tags: dict[str, str] | None = None,
        feature_service: FeatureService | None = None,
    ) -> SavedDataset:
        """Run a retrieval and keep its rows under a name."""
        service = feature_service.name if feature_service else None
        return self.datasets.save(from_, name, storage, tags, service)

    def get_saved_dataset(self, name: str) -> SavedDataset:
        return self.datasets.get(name)

    def as_reference(self, dataset: SavedDataset, profiler: Profiler | None = None) -> Reference:
        return self.datasets.as_reference(dataset, profiler)

    # -- helpers -------------------------------------------------------------------

    def _feature_view(self, name: str) -> FeatureView:
        view = self.view(name)
        if not isinstance(view, FeatureView):
            raise TidemarkError(f"view {name!r} has no source of its own")
        return view

    def _roles(self, view: FeatureView) -> tuple[str, str | None, list[str], list[str]]:
        """Event time, created time, keys and features by their mapped names."""
        source = view.source
        if source is None:
            raise TidemarkError(f"view {view.name!r} has no batch source")
        keys = [self._entities[n].join_key for n in view.entities]
        values = [f.name for f in view.features]
        ts = source.mapped(source.event_timestamp_column)
        return ts, source.mapped(source.created_timestamp_column), keys, values

    def _declared(self, view: FeatureView) -> dict[str, DataType]:
        """Types of a view's snapshot columns, the same for every load."""
        declared = {f.name: f.dtype for f in view.features}
        for name in view.entities:
            entity = self._entities[name]
            if entity.value_type is not None:
                declared[entity.join_key] = entity.value_type
        return declared

    def _push_times(self, view: FeatureView, df: DataFrame) -> tuple[str, str | None]:
        for source in (view.stream_source, view.source):
            event = getattr(source, "event_timestamp_column", None)
            if event:
                mapping = source.field_mapping
                created = source.created_timestamp_column
                created = mapping.get(created, created)
                event = mapping.get(event, event)
                return event, created if created in df.columns else None
        return infer_spine_time(df), None

    def _online_views(self, names: list[str] | None) -> list[FeatureView]:
        if names is None:
            return [
                v
                for v in self._views.values()
                if isinstance(v, FeatureView) and v.online and v.source is not None
            ]
        views = [self._feature_view(n) for n in names]
        for v in views:
            if not v.online:
                raise TidemarkError(f"view {v.name!r} is not kept online")
        return views


def _reject_duplicates(definitions: list[Definition]) -> None:
    for kinds in ((FeatureView, RequestView, OnDemandView), (BatchSource, PushSource), (Entity,)):
        seen: set[str] = set()
        for d in definitions:
            if isinstance(d, kinds) and d.name:
                if d.name.casefold() in seen:
                    raise DuplicateName(f"{d.name!r} is defined twice")
                seen.add(d.name.casefold())


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
