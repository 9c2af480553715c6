"""Feeding a stream into a snapshot."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def push_stream(
    stream: DataFrame,
    push: Callable[[DataFrame, str], None],
    checkpoint: str,
    name: str,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Push every micro-batch; ``push`` gets the rows and a version fixed per batch.

    A batch that is run again after a failure replaces its own rows, and "newest event
    wins" makes the order of batches irrelevant, so each row counts exactly once.
    ``checkpoint`` must be in a folder all executors share.
    """

    started: Future[str] = Future()

    def each(batch: DataFrame, batch_id: int) -> None:
        # The id is kept in the checkpoint: the same after a restart, new for a new stream.
        push(batch, f"{name}-{started.result()}-{batch_id:012d}")

    query = (
        stream.writeStream.queryName(f"{name}-{uuid.uuid4().hex[:8]}")
        .outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    started.set_result(str(query.id))
    return query
