"""Where feature rows come from."""

from tidemark.sources.batch import (
    BatchSource,
    ConnectorSource,
    FileSource,
    FrameSource,
    QuerySource,
    TableSource,
)
from tidemark.sources.spine import as_spine, infer_spine_time, require_columns
from tidemark.sources.streams import KafkaSource, KinesisSource, PushSource, StreamSource

__all__ = [
    "BatchSource",
    "ConnectorSource",
    "FileSource",
    "FrameSource",
    "KafkaSource",
    "KinesisSource",
    "PushSource",
    "QuerySource",
    "StreamSource",
    "TableSource",
    "as_spine",
    "infer_spine_time",
    "require_columns",
]
