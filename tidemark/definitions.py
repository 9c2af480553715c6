"""What users declare: entities, features, views over sources, transforms, services."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import timedelta
from typing import Any

from pyspark.sql import types as T

from tidemark.errors import FeatureNotFound
from tidemark.functions.types import ValueType, spark_type
from tidemark.sources.batch import BatchSource
from tidemark.sources.streams import PushSource, StreamSource

# Key of views without entities in a snapshot: fixed name and value.
DUMMY_KEY = "__dummy_id"
DUMMY_VALUE = ""

TypeLike = ValueType | T.DataType | str


@dataclass(frozen=True)
class Entity:
    """Something features describe, found by a join key (its name unless given)."""

    name: str
    value_type: TypeLike | None = None
    join_key: str = ""
    description: str = ""

    def __post_init__(self) -> None:
        if not self.join_key:
            object.__setattr__(self, "join_key", self.name)
        if self.value_type is not None:
            object.__setattr__(self, "value_type", spark_type(self.value_type))


@dataclass(frozen=True)
class Feature:
    """A named, typed value."""

    name: str
    dtype: TypeLike

    def __post_init__(self) -> None:
        object.__setattr__(self, "dtype", spark_type(self.dtype))


@dataclass(frozen=True)
class RequestSource:
    """Columns the caller supplies with the request."""

    name: str
    schema: dict[str, TypeLike]

    def types(self) -> dict[str, T.DataType]:
        return {n: spark_type(t) for n, t in self.schema.items()}


class _Projectable:
    """Choosing features of a view and renaming it for one request."""

    name: str
    features: tuple[Feature, ...]
    alias: str
    selected: tuple[str, ...] | None

    @property
    def name_to_use(self) -> str:
        return self.alias or self.name

    def with_name(self, alias: str):
        """The view under another name in this request."""
        return replace(self, alias=alias)

    def __getitem__(self, names: list[str]):
        """The view with only the named features."""
        names = (names,) if isinstance(names, str) else tuple(names)
        self.require(names)
        return replace(self, selected=names)

    def require(self, names) -> None:
        """Raise unless every name is a feature of this view."""
        known = {f.name for f in self.features}
        unknown = [n for n in names if n not in known]
        if unknown:
            raise FeatureNotFound(f"view {self.name!r} has no features {unknown}")

    @property
    def projected(self) -> tuple[Feature, ...]:
        """Features in the projection; all of them unless a subset was chosen."""
        if self.selected is None:
            return self.features
        by_name = {f.name: f for f in self.features}
        return tuple(by_name[n] for n in self.selected)


@dataclass(frozen=True)
class FeatureView(_Projectable):
    """Features of one source for one set of entities.

    ``ttl`` limits how old a value may be (None or zero: no limit).  Features left out
    are inferred from the source when the view is registered.
    """

    name: str
    entities: tuple[str, ...]
    source: BatchSource | None
    features: tuple[Feature, ...] = ()
    ttl: timedelta | None = None
    online: bool = True
    stream_source: StreamSource | PushSource | None = None
    tags: dict[str, str] = field(default_factory=dict)
    alias: str = ""
    selected: tuple[str, ...] | None = None
    join_key_map: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "entities", tuple(self.entities))
        object.__setattr__(self, "features", tuple(self.features))

    def with_join_key_map(self, mapping: dict[str, str]) -> FeatureView:
        """Join on other spine columns: ``{join key: spine column}``."""
        return replace(self, join_key_map={**self.join_key_map, **mapping})


@dataclass(frozen=True)
class RequestView(_Projectable):
    """Request columns exposed as features."""

    name: str
    source: RequestSource
    features: tuple[Feature, ...] = ()
    alias: str = ""
    selected: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        columns = tuple(Feature(n, t) for n, t in self.source.schema.items())
        object.__setattr__(self, "features", columns)


@dataclass(frozen=True)
class OnDemandView(_Projectable):
    """Features computed per row from other features and request columns.

    With ``mode="columns"`` the function maps a dict of Columns to a dict of Columns and
    runs inside the JVM.  With ``mode="pandas"`` it maps a pandas frame to a pandas frame
    with as many rows, and runs on Arrow batches of only its input columns.  Either way
    inputs are found under both ``feature`` and ``view__feature``.
    """

    name: str
    inputs: tuple[FeatureView | RequestSource, ...]
    fn: Callable[[Any], Any]
    features: tuple[Feature, ...] = ()
    mode: str = "columns"
    tags: dict[str, str] = field(default_factory=dict)
    alias: str = ""
    selected: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("columns", "pandas"):
            raise ValueError("mode must be 'columns' or 'pandas'")
        object.__setattr__(self, "inputs", tuple(self.inputs))
        object.__setattr__(self, "features", tuple(self.features))

    @property
    def input_views(self) -> tuple[FeatureView, ...]:
        return tuple(i for i in self.inputs if isinstance(i, FeatureView))

    def request_schema(self) -> dict[str, T.DataType]:
        """Columns the caller has to supply."""
        schema: dict[str, T.DataType] = {}
        for source in self.inputs:
            if isinstance(source, RequestSource):
                schema.update(source.types())
        return schema


def on_demand_view(
    inputs, features=(), mode: str = "columns", name: str = ""
) -> Callable[[Callable], OnDemandView]:
    """Decorator turning a function into an :class:`OnDemandView` named after it."""

    def wrap(fn: Callable) -> OnDemandView:
        return OnDemandView(name or fn.__name__, tuple(inputs), fn, tuple(features), mode)

    return wrap


AnyView = FeatureView | RequestView | OnDemandView


@dataclass(frozen=True)
class FeatureService:
    """A named list of views (with their projections): what one model needs."""

    name: str
    views: tuple[AnyView, ...]
    tags: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "views", tuple(self.views))
