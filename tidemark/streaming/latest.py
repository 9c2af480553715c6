"""Latest row per key, maintained while a stream runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.latest import latest_per_key


def latest_stream(
    stream: DataFrame, keys: list[str], ts: str, created: str | None = None
) -> DataFrame:
    """Write this in ``update`` mode: each batch emits the keys whose latest row changed.

    The state is one row per key, kept by Spark's state store; late rows lose against it
    whenever they arrive, so no watermark is needed.
    """
    return latest_per_key(stream, keys, [ts] if created is None else [ts, created])


def drop_retries(stream: DataFrame, ids: list[str], ts: str, delay: str) -> DataFrame:
    """Drop rows delivered again within ``delay`` (such as "10 minutes") of event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(ids)


