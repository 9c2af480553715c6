"""Feature data on Spark: point-in-time joins, latest-value snapshots, lookups, checks."""

from tidemark.datasets import FileStorage, Reference, Retrieval, SavedDataset, TableStorage
from tidemark.definitions import (
    Entity,
    Feature,
    FeatureService,
    FeatureView,
    OnDemandView,
    RequestSource,
    RequestView,
    on_demand_view,
)
from tidemark.functions.types import ValueType
from tidemark.sources import (
    ConnectorSource,
    FileSource,
    FrameSource,
    KafkaSource,
    KinesisSource,
    PushSource,
    QuerySource,
    StreamSource,
    TableSource,
)
from tidemark.store import FeatureStore

__all__ = [
    "ConnectorSource",
    "Entity",
    "Feature",
    "FeatureService",
    "FeatureStore",
    "FeatureView",
    "FileSource",
    "FileStorage",
    "FrameSource",
    "KafkaSource",
    "KinesisSource",
    "OnDemandView",
    "PushSource",
    "QuerySource",
    "Reference",
    "RequestSource",
    "RequestView",
    "Retrieval",
    "SavedDataset",
    "StreamSource",
    "TableSource",
    "TableStorage",
    "ValueType",
    "on_demand_view",
]
