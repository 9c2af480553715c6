"""Turning feature references into the views, inputs and output names of one request."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from tidemark.definitions import (
    AnyView,
    FeatureService,
    FeatureView,
    OnDemandView,
    RequestView,
)
from tidemark.errors import FeatureNameCollision, MissingRequestData, ViewNotFound


@dataclass(frozen=True)
class Wanted:
    """A view with the features asked of it."""

    view: AnyView
    names: tuple[str, ...]


@dataclass(frozen=True)
class Request:
    """Resolved request.

    ``wanted`` holds what the caller asked for, in order.  ``fetched`` holds, per view to
    read, everything needed: asked-for features and inputs of on-demand views.
    """

    wanted: tuple[Wanted, ...]
    fetched: tuple[Wanted, ...]
    full_names: bool

    def output_name(self, view: AnyView, feature: str) -> str:
        return f"{view.name_to_use}__{feature}" if self.full_names else feature

    def outputs(self) -> list[tuple[AnyView, str, str]]:
        """(view, feature, output column) in the order asked for."""
        return [(w.view, n, self.output_name(w.view, n)) for w in self.wanted for n in w.names]

    @property
    def refs(self) -> list[str]:
        return [f"{w.view.name_to_use}:{n}" for w in self.wanted for n in w.names]

    def on_demand(self) -> list[Wanted]:
        return [w for w in self.wanted if isinstance(w.view, OnDemandView)]


def parse_ref(ref: str) -> tuple[str, str]:
    view, sep, feature = ref.partition(":")
    if not sep or not view or not feature:
        raise ViewNotFound(f"feature reference {ref!r} is not of the form 'view:feature'")
    return view, feature


def resolve(
    features: Iterable[str] | FeatureService,
    views: dict[str, AnyView],
    full_names: bool,
) -> Request:
    """Resolve references or a service; raises on unknown and on colliding names."""
    if isinstance(features, FeatureService):
        wanted = []
        for view in features.views:
            if view.name not in views:
                raise ViewNotFound(f"service {features.name!r} uses unknown view {view.name!r}")
            current = _project(views[view.name], view)
            wanted.append(Wanted(current, tuple(f.name for f in current.projected)))
    else:
        by_view: dict[str, list[str]] = {}
        for ref in features:
            name, feature = parse_ref(ref)
            if name not in views:
                raise ViewNotFound(f"no view {name!r}")
            by_view.setdefault(name, []).append(feature)
        wanted = [Wanted(views[name], tuple(names)) for name, names in by_view.items()]
        for item in wanted:
            item.view.require(item.names)

    request = Request(tuple(wanted), tuple(_fetched(wanted, views)), full_names)
    _check_collisions(request)
    return request


def _project(registered: AnyView, projection: AnyView) -> AnyView:
    """The registered view with another view's projection applied."""
    if projection.selected is not None:
        registered.require(projection.selected)
    view = registered.with_name(projection.alias)
    if projection.selected is not None:
        view = view[list(projection.selected)]
    if isinstance(view, FeatureView) and projection.join_key_map:
        view = view.with_join_key_map(projection.join_key_map)
    return view


def _fetched(wanted: list[Wanted], views: dict[str, AnyView]) -> list[Wanted]:
    """Views to read, each once, with the inputs of on-demand views pulled in."""
    needs: dict[tuple, tuple[FeatureView, dict[str, None]]] = {}

    def add(view: FeatureView, names: Iterable[str]) -> None:
        _, known = needs.setdefault(view_key(view), (view, {}))
        known.update(dict.fromkeys(names))

    for item in wanted:
        if isinstance(item.view, FeatureView):
            add(item.view, item.names)
        elif isinstance(item.view, OnDemandView):
            for view in item.view.input_views:
                if view.name not in views:
                    raise ViewNotFound(f"{item.view.name!r} uses unknown view {view.name!r}")
                projected = _project(views[view.name], view)
                add(projected, [f.name for f in projected.projected])
    return [Wanted(view, tuple(names)) for view, names in needs.values()]


def view_key(view: FeatureView) -> tuple:
    """What makes two uses of a view the same read."""
    return view.name, view.name_to_use, tuple(sorted(view.join_key_map.items()))


def _check_collisions(request: Request) -> None:
    seen: dict[str, str] = {}
    for view, feature, output in request.outputs():
        ref = f"{view.name_to_use}:{feature}"
        if output in seen:
            raise FeatureNameCollision(
                f"{seen[output]} and {ref} would both be called {output!r}; "
                "ask for full names or for a view under another name"
            )
        seen[output] = ref


def check_request_data(request: Request, columns: Iterable[str]) -> None:
    """Raise if a column the caller has to supply is missing."""
    have = set(columns)
    for item in request.wanted:
        if isinstance(item.view, RequestView):
            needed = set(item.names)
        elif isinstance(item.view, OnDemandView):
            needed = set(item.view.request_schema())
        else:
            continue
        if needed - have:
            raise MissingRequestData(
                f"{item.view.name!r} needs the request columns {sorted(needed - have)}"
            )
