"""Snapshots, lookups and streams."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import Feature, FeatureStore, FeatureView, PushSource, RequestSource, on_demand_view
from tidemark.operators.latest import CREATED_TS, EVENT_TS, REMOVED_AT
from tidemark.operators.lookup import request_sizes, status_counts
from tidemark.plans.sizes import Limits, scanned_bytes
from tidemark.session import shared_folder
from tidemark.sources.streams import StreamSource
from tidemark.streaming import drop_retries, expiring_stream, latest_stream, push_stream
from tidemark.streaming.expiry import ROCKSDB
from workloads import views as v

FIRST = datetime(2024, 1, 1)
MIDDLE = datetime(2024, 1, 15)
LATE = datetime(2024, 1, 25)


def _rows(fs: FeatureStore, view: str, keys: list[str], now: datetime | None = None) -> DataFrame:
    """A snapshot under plain column names."""
    found = fs.snapshots.read(view, keys, key_ttl=fs.key_ttl, now=now)
    return found.select(
        *keys,
        "value",
        "event_type",
        F.col(EVENT_TS).alias("event_ts"),
        F.col(CREATED_TS).alias("created_ts"),
    )


def materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.last_event(sf_dir))
    fs.materialize(FIRST, MIDDLE, now=v.NOW)
    return _rows(fs, "last_event", ["user_id"])


def materialize_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load starts at ``now - ttl``, the second where the first one ended."""
    fs = v.store(spark, v.last_event(sf_dir, timedelta(days=10)))
    fs.materialize_incremental(MIDDLE, now=MIDDLE)
    fs.materialize_incremental(LATE, now=LATE)
    return _rows(fs, "last_event", ["user_id"])


def _pushed_events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    return v.events_with_created(spark, sf_dir).filter(F.col("event_type").isin(*kinds))


def push_newer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pushes before and after a load; only strictly newer rows count."""
    push = PushSource(
        name="app_events",
        schema={
            "user_id": "bigint",
            "value": "double",
            "event_type": "string",
            "ts": "timestamp_ntz",
            "created": "timestamp_ntz",
        },
        event_timestamp_column="ts",
        created_timestamp_column="created",
    )
    view = v.last_event(sf_dir)
    fs = v.store(spark, push, replace(view, stream_source=push))
    fs.push("app_events", _pushed_events(spark, sf_dir, "signup", "error"), now=MIDDLE)
    fs.materialize(FIRST, MIDDLE, now=LATE)
    fs.push("app_events", _pushed_events(spark, sf_dir, "click"), now=LATE)
    return _rows(fs, "last_event", ["user_id"])


def snapshot_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.last_event(sf_dir))
    for day in (5, 10, 15, 20, 25):
        fs.materialize(datetime(2024, 1, day - 4), datetime(2024, 1, day), now=v.NOW)
    fs.snapshots.compact("last_event", ["user_id"])
    return _rows(fs, "last_event", ["user_id"])


def snapshot_folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pushes of some kinds of events, then a load per few days: full size classes are folded on the way."""
    fs = v.store(spark, v.last_event(sf_dir))
    fs.snapshots.fan = 3
    for kind in ("click", "signup", "error"):
        fs.write_to_online_store("last_event", _pushed_events(spark, sf_dir, kind), now=MIDDLE)
    for day in (5, 10, 15, 20, 25):
        fs.materialize(datetime(2024, 1, day - 4), datetime(2024, 1, day), now=v.NOW)
    return _rows(fs, "last_event", ["user_id"])


def _with_holes(spark: SparkSession, sf_dir: str) -> FeatureStore:
    """Loads that overlap, and leave days out."""
    fs = v.store(spark, v.last_event(sf_dir))
    for first, last in ((2, 6), (5, 8), (12, 16), (16, 18), (22, 24)):
        fs.materialize(datetime(2024, 1, first), datetime(2024, 1, last), now=v.NOW)
    return fs


def materialize_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what no load covered is read, and then nothing is missing."""
    fs = _with_holes(spark, sf_dir)
    fs.materialize(FIRST, LATE, now=v.NOW, missing_only=True)
    assert fs.missing_ranges("last_event", FIRST, LATE) == []
    return _rows(fs, "last_event", ["user_id"])


def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holes between loads, with the number of source rows in each."""
    fs = _with_holes(spark, sf_dir)
    out = None
    for first, last in fs.missing_ranges("last_event", FIRST, LATE):
        rows = fs.pull_all("last_event", first, last)
        part = rows.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(first).cast("timestamp_ntz").alias("range_start"), F.lit(last).cast("timestamp_ntz").alias("range_end"), "rows"
        )
        out = part if out is None else out.unionAll(part)
    return out


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of each load: rows and latest event time, counted while they were written."""
    fs = v.store(spark, v.last_event(sf_dir))
    for day in (5, 10, 15, 20, 25):
        fs.materialize(datetime(2024, 1, day - 4), datetime(2024, 1, day), now=v.NOW)
    return fs.snapshots.log("last_event").filter("kind = 'load'").select("range_start", "range_end", "rows", "latest")


def key_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys not written for five days are gone."""
    fs = v.store(spark, v.last_event(sf_dir), key_ttl=timedelta(days=5))
    fs.materialize(FIRST, MIDDLE, now=MIDDLE)
    late = _pushed_events(spark, sf_dir, "purchase")
    fs.write_to_online_store("last_event", late, now=LATE)
    return _rows(fs, "last_event", ["user_id"], now=datetime(2024, 1, 28))


def snapshot_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two views are loaded, one is given up; its rows are gone."""
    fs = v.store(spark, v.last_event(sf_dir), v.last_event(sf_dir, name="old_view"))
    fs.materialize(FIRST, MIDDLE, now=v.NOW)
    keep = v.store(spark, v.last_event(sf_dir))
    keep.snapshots = fs.snapshots
    keep.drop_unused_snapshots()
    out = None
    for name in ("last_event", "old_view"):
        rows = fs.snapshots.read(name, ["user_id"])
        if rows is None:
            continue
        counted = rows.agg(F.lit(name).alias("view"), F.count(F.lit(1)).alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


# -- lookups --------------------------------------------------------------------


def _gappy_source(sf_dir: str) -> v.QuerySource:
    """Events whose errors carry no value."""

    def read(spark: SparkSession) -> DataFrame:
        known = F.when(F.col("event_type") != "error", F.col("value"))
        return v.events_with_created(spark, sf_dir).withColumn("value", known)

    return v.QuerySource(
        name="gappy",
        query=read,
        event_timestamp_column="ts",
        created_timestamp_column="created",
    )


def _gappy(sf_dir: str, ttl: timedelta | None = None) -> FeatureView:
    features = [Feature("value", "double"), Feature("event_type", "string")]
    return FeatureView("gappy", ["user"], _gappy_source(sf_dir), features, ttl)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order: repeated ids, and ids no event ever had."""
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_id")
    )


REFS = ["gappy:value", "gappy:event_type"]


def _loaded(spark: SparkSession, sf_dir: str, *views, **options) -> FeatureStore:
    fs = v.store(spark, *views, **options)
    fs.materialize(FIRST, v.NOW, now=v.NOW)
    return fs


def online_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = _loaded(spark, sf_dir, _gappy(sf_dir))
    return fs.get_online_features(REFS, _requests(spark, sf_dir), now=v.NOW, metadata=False)


def online_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups in a snapshot stored in buckets of the user, beside a push that is not."""
    limits = Limits(small_bytes=1 << 40, bucket_bytes=4096)
    fs = _loaded(spark, sf_dir, _gappy(sf_dir), limits=limits)
    late = v.events_with_created(spark, sf_dir).filter(F.col("event_type") == "click")
    fs.write_to_online_store("gappy", late, now=v.NOW)
    return fs.get_online_features(REFS, _requests(spark, sf_dir), now=v.NOW, metadata=False)


def online_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = _loaded(spark, sf_dir, _gappy(sf_dir, timedelta(hours=12)))
    # The entity's name stands in for its join key.
    requests = _requests(spark, sf_dir).withColumnRenamed("user_id", "user")
    return fs.get_online_features(REFS, requests, True, now=v.NOW)


def online_entityless(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = _loaded(spark, sf_dir, v.daily_totals(sf_dir))
    requests = v.table(spark, sf_dir, "customer").select("c_custkey")
    refs = ["daily_totals:n_events", "daily_totals:total_value"]
    return fs.get_online_features(refs, requests, now=v.NOW, metadata=False)


def status_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = _loaded(spark, sf_dir, _gappy(sf_dir, timedelta(hours=12)))
    found = fs.get_online_features(REFS, _requests(spark, sf_dir), now=v.NOW)
    return status_counts(found, ["value", "event_type"])


def lookup_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups of every order line's supplier, one request per order."""
    fs = v.store(spark, v.supplier_daily(sf_dir))
    fs.materialize(datetime(1990, 1, 1), datetime(2010, 1, 1), now=v.NOW)
    requests = v.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    found = fs.get_online_features(["supplier_daily:day_lines"], requests, now=v.NOW)
    return request_sizes(found, "l_orderkey")


def odfv_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _gappy(sf_dir)
    request = RequestSource("extra", {"to_add": "int"})

    @on_demand_view([view, request], [Feature("value_plus", "double")])
    def added(c):
        return {"value_plus": F.round(c["gappy__value"] + c["to_add"], 2)}

    fs = _loaded(spark, sf_dir, view, added)
    requests = _requests(spark, sf_dir).withColumn("to_add", (F.col("o_orderkey") % 7).cast("int"))
    return fs.get_online_features(["added:value_plus"], requests, now=v.NOW, metadata=False)


# -- streams ----------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = v.table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    stream = reader.parquet(sf_dir)
    delay = F.make_dt_interval(F.lit(0), (F.col("event_id") % 5).cast("int"))
    return stream.withColumn("created", F.col("ts") + delay)


def stream_push(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch load, then every event again as a stream: newer ones win, none counts twice."""
    fs = v.store(spark, v.last_event(sf_dir))
    fs.materialize(FIRST, MIDDLE, now=v.NOW)
    checkpoint = shared_folder(spark, "stream-push")
    query = fs.push_stream("last_event", checkpoint, _event_stream(spark, sf_dir), now=v.NOW)
    query.awaitTermination()
    return _rows(fs, "last_event", ["user_id"])


def stream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a JSON payload, as a message queue would deliver them, one file a time."""
    folder = shared_folder(spark, "messages")
    events = v.events_with_created(spark, sf_dir)
    body = F.struct("user_id", "value", "event_type", "ts", "created", "event_id")
    shape = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    messages = events.select(F.to_json(body, shape).alias("value"))
    messages.repartition(3).write.mode("overwrite").text(folder)
    source = StreamSource(
        name="messages",
        format="text",
        options={"path": folder, "maxFilesPerTrigger": "1"},
        payload_format="json",
        payload_options=shape,
        payload_schema=(
            "user_id bigint, value double, event_type string, "
            "ts timestamp_ntz, created timestamp_ntz, event_id bigint"
        ),
    )
    fs = v.store(spark, replace(v.last_event(sf_dir), stream_source=source))
    query = fs.push_stream("last_event", shared_folder(spark, "stream-json"), now=v.NOW)
    query.awaitTermination()
    return _rows(fs, "last_event", ["user_id"])


EXPIRY = timedelta(hours=6)


WEEK_FILE_BYTES = 4 * 1024 * 1024


def _files_a_week(size: int | None) -> int:
    """Files of a fifth of a table of so many bytes."""
    return 1 if size is None else max(1, -(-size // (5 * WEEK_FILE_BYTES)))


def _in_batches(spark: SparkSession, sf_dir: str, run) -> None:
    """Events as they come in, a week a batch; the stream is stopped once on the way.

    A week is one file, or as many as its size asks for, so that large weeks are written and
    read by several tasks.
    """
    folder = shared_folder(spark, "events-in")
    events = v.events_with_created(spark, sf_dir)
    files = _files_a_week(scanned_bytes(events))
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)
    try:
        for weeks in ((0, 1), (2, 3, 4)):
            for n in weeks:
                rows = events.filter(week == n)
                rows = rows.coalesce(1) if files == 1 else rows.repartition(files)
                rows.write.mode("append").parquet(folder)
            stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(folder)
            run(stream).awaitTermination()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def stream_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot fed by a stream that ends users without an event for six hours."""
    fs = v.store(spark, v.last_event(sf_dir))
    checkpoint = shared_folder(spark, "stream-expiry")

    def run(stream: DataFrame):
        return fs.push_stream("last_event", checkpoint, stream, now=v.NOW, key_ttl=EXPIRY, delay="1 hour")

    _in_batches(spark, sf_dir, run)
    return _rows(fs, "last_event", ["user_id"])


def stream_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time a user ended: the last event before, and when."""
    checkpoint, folder = shared_folder(spark, "stream-removals"), shared_folder(spark, "removals")

    def write(batch: DataFrame, version: str) -> None:
        removed = batch.filter(F.col(REMOVED_AT).isNotNull())
        # a batch that runs again writes the same folder
        removed.write.mode("overwrite").parquet(f"{folder}/batch={version}")

    def run(stream: DataFrame):
        changes = expiring_stream(stream.select("user_id", "ts", "event_type"), ["user_id"], "ts", EXPIRY, "1 hour")
        return push_stream(changes, write, checkpoint, "removals", mode="update")

    _in_batches(spark, sf_dir, run)
    return spark.read.parquet(folder).select("user_id", "ts", "event_type", F.col(REMOVED_AT).alias("removed_at"))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per user kept as streaming state; retried deliveries are dropped first."""
    fs = v.store(spark, v.last_event(sf_dir))
    unique = drop_retries(
        _event_stream(spark, sf_dir).withColumn("ts_w", F.col("ts").cast("timestamp")),
        ["event_id"],
        "ts_w",
        "30 days",
    ).drop("ts_w")
    columns = unique.select("user_id", "ts", "created", "value", "event_type")
    changes = latest_stream(columns, ["user_id"], "ts", "created")

    def push(batch: DataFrame, version: str) -> None:
        fs.write_to_online_store("last_event", batch, v.NOW, version)

    query = push_stream(
        changes, push, shared_folder(spark, "stream-latest"), "latest", mode="update"
    )
    query.awaitTermination()
    return _rows(fs, "last_event", ["user_id"])
