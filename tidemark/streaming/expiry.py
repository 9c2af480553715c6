"""Latest row per key with an end: keys that are not written to for a while are removed.

The newest row of every key is held as state.  A timer in event time ends it once the
stream's watermark is ``ttl`` past that row, and a later row of the key starts it anew.
Unlike a rewrite of the whole snapshot, this costs what changes, and state does not grow with
keys that are gone.  Needs the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.columns import q
from tidemark.operators.latest import REMOVED_AT

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_TIME = "__ft_time"
_KEPT = "__ft_kept"


class _Expiring(StatefulProcessor):
    """Holds time, rank among equal times and JSON of a key's newest row.

    Every call to the state leaves the Python process, so a key has one timer as long as it is
    held, which later rows do not move: it looks when it fires whether the key ends by then.
    """

    def __init__(self, ttl: timedelta):
        self.ttl = ttl // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", f"{_TIME} bigint, rank string, {_KEPT} string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = before = self._held()
        for found in sorted((r[_TIME], r["rank"], r[_KEPT]) for r in rows):
            if held is not None and found <= held:
                continue
            if held is not None and found[0] - held[0] > self.ttl:
                yield self._row(held, held[0] + self.ttl)
            held = found
        if held is not None and held != before:
            self.newest.update(held)
            if before is None:
                self.handle.registerTimer(self._end(held))
            yield self._row(held, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        if held is None:
            return
        if self._end(held) >= timerValues.getCurrentWatermarkInMs():  # as Spark tells timers that are not due
            self.handle.registerTimer(self._end(held))
        else:
            self.newest.clear()
            yield self._row(held, held[0] + self.ttl)

    def close(self) -> None:
        pass

    def _held(self) -> tuple | None:
        found = self.newest.get()
        return None if found is None else tuple(found)

    def _end(self, held: tuple) -> int:
        """Timers count milliseconds: the first that is not before the end."""
        return -(-(held[0] + self.ttl) // 1000)

    @staticmethod
    def _row(held: tuple, removed: int | None) -> Row:
        return Row(**{_KEPT: held[2], REMOVED_AT: removed})


def expiring_stream(
    stream: DataFrame, keys: list[str], ts: str, ttl: timedelta, delay: str, created: str | None = None
) -> DataFrame:
    """Changes of the latest row per key, as rows of the stream's columns and ``REMOVED_AT``.

    A row without ``REMOVED_AT`` is a key's new latest row; one with it says that the key
    ended then, ``ttl`` after the row shown.  A key ends between two of its rows that are
    further apart than ``ttl``, however they are split into batches, and after its last row
    once the watermark (``delay`` behind the latest time of the stream) gets there.  Rows
    later than ``delay`` are dropped.  Write it in ``update`` mode.
    """
    session = stream.sparkSession
    if session.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    schema = stream.schema
    recency = [c for c in (ts, created) if c]
    rest = [c for c in stream.columns if c not in (*keys, *recency)]
    micros = F.unix_micros(q(ts).cast("timestamp"))
    shape = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    # text that sorts like the created time; ties go to the greatest row as text
    later = F.lpad(F.unix_micros(q(created).cast("timestamp")).cast("string"), 20, "0") if created else F.lit("")
    packed = F.to_json(F.struct(*[q(c) for c in stream.columns]), shape)
    rows = stream.select(
        *[q(k) for k in keys],
        q(ts).cast("timestamp").alias("__ft_at"),
        micros.alias(_TIME),
        F.concat(F.coalesce(later, F.lit("")), F.lit(" "), F.to_json(F.struct(*[q(c) for c in rest]), shape)).alias("rank"),
        packed.alias(_KEPT),
    ).withWatermark("__ft_at", delay)
    changes = rows.groupBy(*[q(k) for k in keys]).transformWithState(
        statefulProcessor=_Expiring(ttl),
        outputStructType=f"{_KEPT} string, {REMOVED_AT} bigint",
        outputMode="Update",
        timeMode="EventTime",
    )
    row = F.from_json(_KEPT, T.StructType(schema.fields), shape)
    changes = changes.select(row.alias("row"), F.timestamp_micros(REMOVED_AT).cast("timestamp_ntz").alias(REMOVED_AT))
    return changes.select("row.*", REMOVED_AT)
