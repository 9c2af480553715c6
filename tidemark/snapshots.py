"""The latest value of every entity, kept as Parquet.

Every load writes a folder of its own and then one log record that names it
(``snapshot_log.py``).  A folder is never written to again once the log names it, so readers
are never disturbed, and a load that failed half way is not seen.  Reading merges the
current folders ("newest event wins").

Folders of about equal size are folded into one when there are several, so n loads leave
about log n folders, and every row is rewritten about log n times.  Large folders are written
in buckets of the key, and a lookup of a few keys reads only the buckets these fall into.

A row that removes its key takes part as any other and is left out when read, so an older
row that arrives late does not bring the key back.
"""

from __future__ import annotations

import json
import math
import uuid
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import SmallFiles
from tidemark.functions.columns import q
from tidemark.functions.times import time_literal, to_utc
from tidemark.operators.latest import CREATED_TS, EVENT_TS, REMOVED_AT, WRITTEN_AT, latest_per_key
from tidemark.plans.sizes import DEFAULT_LIMITS, Limits, is_small, known_bytes
from tidemark.snapshot_log import DROP, FOLD, LOAD, PURGE, Record, ViewLog

# Among rows of equal times the one written first stays: a greater number is older.
_AGE = "__ft_age"
# Folders on the way to a file; they become columns of what is read.
_LOAD = "__ft_load"
_BUCKET = "__ft_bucket"
_LAYOUT = T.StructType([T.StructField(_LOAD, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])

# Folders of one size class that are folded together, and rows of the smallest class.
FAN = 8
SMALLEST_CLASS = 10_000


class Snapshots:
    """Snapshot tables below one folder, one per view.

    ``fan`` folders of one size class are folded into one by the load that completes them;
    with None folders are only folded by ``compact`` and ``purge``.
    """

    def __init__(self, spark: SparkSession, root: str, limits: Limits = DEFAULT_LIMITS, fan: int | None = FAN):
        self.spark = spark
        self.root = root.rstrip("/")
        self.limits = limits
        self.fan = fan
        self.files = SmallFiles(spark)

    # -- the log ---------------------------------------------------------------

    def _log(self, view: str) -> ViewLog:
        return ViewLog(self.spark, f"{self.root}/_loads/{view}")

    def log(self, view: str) -> DataFrame:
        """Every load, fold and drop of a view so far."""
        return self._log(view).history()

    def intervals(self, view: str) -> DataFrame:
        """Time ranges loaded into a view, in load order."""
        return (
            self.log(view)
            .filter(F.col("range_end").isNotNull())
            .select("seq", "range_start", "range_end")
        )

    def last_end(self, view: str) -> datetime | None:
        """Latest end of any range loaded since the view was last dropped."""
        end = self._log(view).state().last_end
        return None if end is None else datetime.fromisoformat(end)

    def gaps(self, view: str, start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
        """The parts of a time range that no load has covered since the last drop; ends belong to them."""
        start, end = to_utc(start), to_utc(end)
        missing, at = [], start
        for first, last, is_open, _ in self._log(view).state().ranges:
            first, last = datetime.fromisoformat(first), datetime.fromisoformat(last)
            if last < at or last == at and is_open:
                continue
            if first > end:
                break
            if first > at:
                missing.append((at, first))
            at = last
            if last > end or last == end and not is_open:
                return missing
        return [*missing, (at, end)]

    def versions(self, view: str) -> list[Record]:
        """Current folders of a view, oldest first.

        Of a version loaded several times the newest folder counts.
        """
        return list(self._log(view).state().live)

    def views(self) -> list[str]:
        """Names of views that have been loaded at least once."""
        return self.files.names(f"{self.root}/_loads")

    # -- writing ---------------------------------------------------------------

    def add(
        self,
        view: str,
        rows: DataFrame,
        at: datetime,
        start: datetime | None = None,
        end: datetime | None = None,
        version: str | None = None,
        keys: list[str] | None = None,
        closed: str = "both",
    ) -> None:
        """Add rows (keys, values, event and created time), one per key.

        A load with a fixed ``version`` may be repeated: its newest folder takes the place
        of the ones before it, and its rows keep the age of the first.  With ``keys`` a
        large load is written in buckets, and full size classes are folded.
        """
        log = self._log(view)
        state = log.state()
        seq = log.next_seq(state)
        first = min((r.first for r in state.live if version is not None and r.version == version), default=seq)
        stamped = rows.withColumn(WRITTEN_AT, time_literal(at, T.TimestampNTZType())).withColumn(_AGE, F.lit(-first))
        folder = uuid.uuid4().hex
        written = self._write(view, folder, stamped, keys, known_bytes(rows))
        at, start, end = (None if t is None else to_utc(t).isoformat() for t in (at, start, end))
        log.append(
            Record(
                LOAD, view, seq, folder, version or folder, first, range_start=start, range_end=end, recorded_at=at,
                range_open=closed == "left", **written,
            )
        )
        if keys and self.fan:
            self._fold_classes(view, keys)

    def _write(self, view: str, folder: str, rows: DataFrame, keys: list[str] | None, size: int | None) -> dict:
        """Write a folder; what its log record says of it, counted by the same job."""
        buckets = self._buckets(size) if keys else 1
        counted = Observation()
        latest = [F.max(EVENT_TS).alias("latest")] if EVENT_TS in rows.columns else []
        out = rows.observe(counted, F.count(F.lit(1)).alias("rows"), *latest)
        out = out.withColumn(_BUCKET, _bucket(keys, buckets) if buckets > 1 else F.lit(0))
        out = out.repartition(buckets, _BUCKET) if buckets > 1 else out
        path = self._folder(view, folder)
        out.write.partitionBy(_BUCKET).mode("errorifexists").parquet(path)
        found = counted.get
        latest = found.get("latest")
        return {
            "columns": rows.schema.json(),
            "buckets": buckets,
            "rows": found["rows"],
            "bytes": self.files.size(path),
            "latest": latest.isoformat() if latest else None,
        }

    def _buckets(self, size: int | None) -> int:
        """A power of two, so that a bucket of few buckets is made of whole ones of many."""
        size = self.limits.bucket_bytes if size is None else size
        wanted = max(1, math.ceil(size / self.limits.bucket_bytes))
        return min(self.limits.max_buckets, 1 << (wanted - 1).bit_length())

    def _fold_classes(self, view: str, keys: list[str]) -> None:
        """Fold size classes that are full until none is."""
        while True:
            classes: dict[int, list[Record]] = {}
            for record in self.versions(view):
                if record.rows is not None:
                    classes.setdefault(_size_class(record.rows, self.fan), []).append(record)
            full = [held for _, held in sorted(classes.items()) if len(held) >= self.fan]
            if not full:
                return
            self._replace(view, self._merged(view, full[0], keys), full[0], keys)

    def compact(self, view: str, keys: list[str]) -> None:
        """Fold all current folders of a view into one."""
        live = self.versions(view)
        if len(live) > 1:
            self._replace(view, self._merged(view, live, keys), live, keys)

    def purge(self, view: str, keys: list[str], key_ttl: timedelta, now: datetime) -> None:
        """Rewrite a view without the keys whose last write is older than ``key_ttl``.

        Folders added meanwhile stay.  A fold of the same folders gives way; if another
        purge, or a fold that is summed up already, was first, this one starts again.
        """
        while live := self.versions(view):
            merged = self._merged(view, live, keys)
            folder = self._replace(view, unexpired(merged, key_ttl, now), live, keys, PURGE)
            if not {r.folder for r in live} & {r.folder for r in self.versions(view)} - {folder}:
                return

    def drop(self, view: str, at: datetime | None = None) -> None:
        """Forget a view's rows and loaded ranges."""
        log = self._log(view)
        at = None if at is None else to_utc(at).isoformat()
        log.append(Record(DROP, view, log.next_seq(log.state()), recorded_at=at))

    def drop_unused(self, used: list[str]) -> list[str]:
        """Drop every view that is not in ``used``; returns what was dropped."""
        unused = sorted(v for v in set(self.views()) - set(used) if self.versions(v))
        for view in unused:
            self.drop(view)
        return unused

    def _replace(self, view: str, rows: DataFrame, live: list[Record], keys: list[str] | None = None, kind: str = FOLD) -> str:
        folder = uuid.uuid4().hex
        sizes = [r.bytes for r in live]
        written = self._write(view, folder, rows, keys, None if None in sizes else sum(sizes))
        newest = max(live, key=lambda r: r.seq)
        # As old as the newest rows in it: later loads, and a drop meanwhile, still come after it.
        covers = tuple(r.folder for r in live)
        self._log(view).append(Record(kind, view, newest.seq, folder, folder, newest.seq, covers=covers, **written))
        return folder

    def _folder(self, view: str, folder: str) -> str:
        return f"{self.root}/{view}/{_LOAD}={folder}"

    # -- reading ---------------------------------------------------------------

    def read(
        self,
        view: str,
        keys: list[str],
        only: DataFrame | None = None,
        limits: Limits = DEFAULT_LIMITS,
        key_ttl: timedelta | None = None,
        now: datetime | None = None,
    ) -> DataFrame | None:
        """One row per key, or None if nothing was ever loaded.

        ``only`` holds the few keys that will be looked at.  Other buckets are not read
        then, and where the snapshot is not small, other keys are left out before folders
        are merged.
        """
        merged = self._merged(view, self.versions(view), keys, only, limits)
        if merged is not None and REMOVED_AT in merged.columns:
            merged = merged.filter(q(REMOVED_AT).isNull())
        if merged is not None and key_ttl:
            merged = unexpired(merged, key_ttl, now)
        return None if merged is None else merged.drop(_AGE, REMOVED_AT)

    def _merged(
        self,
        view: str,
        live: list[Record],
        keys: list[str],
        only: DataFrame | None = None,
        limits: Limits = DEFAULT_LIMITS,
    ) -> DataFrame | None:
        if not live:
            return None
        # Folders of one schema are read together; the log knows it, so no footer is opened.
        alike: dict[str, list[Record]] = {}
        for record in live:
            alike.setdefault(record.columns, []).append(record)
        parts = []
        for columns, records in alike.items():
            schema = T.StructType.fromJson(json.loads(columns))
            reader = self.spark.read.schema(T.StructType([*schema.fields, *_LAYOUT.fields]))
            part = reader.option("basePath", f"{self.root}/{view}").parquet(*[self._folder(view, r.folder) for r in records])
            if only is not None:
                wanted = _asked_buckets(records, schema, keys, only)
                part = part if wanted is None else part.filter(wanted)
            parts.append(part.drop(_LOAD, _BUCKET))
        if only is not None and not is_small(limits, *parts):
            parts = [part.join(only, keys, "left_semi") for part in parts]
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if len(live) == 1:
            return union
        return latest_per_key(union, keys, [EVENT_TS, CREATED_TS, _AGE])


def _size_class(rows: int, fan: int) -> int:
    return 0 if rows <= SMALLEST_CLASS else 1 + int(math.log(rows / SMALLEST_CLASS, fan))


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[q(k) for k in keys]), F.lit(buckets)).cast("int")


def _asked_buckets(records: list[Record], schema: T.StructType, keys: list[str], only: DataFrame) -> Column | None:
    """Condition on the folders that hold the buckets of the keys in ``only``; None for all.

    Runs one job that returns at most as many numbers as there are buckets.
    """
    most = max(r.buckets for r in records)
    if most == 1 or not all(_hashes_alike(only.schema[k].dataType, schema[k].dataType) for k in keys):
        return None
    stored = only.select(*[q(k).try_cast(schema[k].dataType).alias(k) for k in keys])
    asked = [r[0] for r in stored.select(_bucket(keys, most)).distinct().collect()]
    by_count: dict[int, list[str]] = {}
    for record in records:
        by_count.setdefault(record.buckets, []).append(record.folder)
    wanted = F.lit(False)
    for buckets, folders in by_count.items():
        wanted = wanted | (q(_LOAD).isin(folders) & q(_BUCKET).isin(sorted({b % buckets for b in asked})))
    return wanted


def _hashes_alike(asked: T.DataType, stored: T.DataType) -> bool:
    """Whether equal values of the two types hash alike once cast to the second."""
    if isinstance(asked, T.IntegralType) and isinstance(stored, T.IntegralType):
        return True
    plain = (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType, T.DecimalType)
    return asked == stored and (isinstance(stored, plain) or stored.simpleString() == "string")


def unexpired(rows: DataFrame, key_ttl: timedelta, now: datetime) -> DataFrame:
    """Snapshot rows written less than ``key_ttl`` before ``now``."""
    oldest = time_literal(to_utc(now) - key_ttl, rows.schema[WRITTEN_AT].dataType)
    return rows.filter(q(WRITTEN_AT) > oldest)
