"""Loads, pushes, lookups and streams."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import hours
from tidemark import Entity, Feature, FeatureStore, FeatureView, FrameSource, PushSource
from tidemark.definitions import DUMMY_KEY
from tidemark.errors import FeatureNameCollision, MissingSpineColumns, SourceValidationError, TidemarkError
from tidemark.operators.latest import CREATED_TS, EVENT_TS, latest_per_key, merge_latest, pull_latest
from tidemark.operators.lookup import request_keys
from tidemark.plans.sizes import Limits
from tidemark.sources.streams import KafkaSource, KinesisSource, StreamSource

DRIVER = Entity("driver", "bigint", "driver_id")
SCHEMA = "driver_id bigint, ts timestamp_ntz, created timestamp_ntz, name string"


def make_store(spark, rows, ttl=None, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    view = FeatureView(
        "stats",
        ["driver"],
        FrameSource(name="s", df=frame, event_timestamp_column="ts", created_timestamp_column="created"),
        [Feature("name", "string")],
        ttl,
    )
    fs = FeatureStore(spark, **options)
    fs.apply(DRIVER, view)
    return fs


def names(fs, ids, now=hours(100)):
    rows = fs.get_online_features(["stats:name"], [{"driver_id": i} for i in ids], now=now).collect()
    return {r["driver_id"]: (r["name"], r["name__status"]) for r in rows}


def test_newest_event_wins_whatever_the_order(spark):
    fs = make_store(spark, [(123, hours(-1), None, "old"), (567, hours(0), None, "L2"), (890, hours(0), None, "L3")])

    def push(*rows):
        fs.write_to_online_store("stats", spark.createDataFrame(list(rows), SCHEMA), now=hours(1))

    push((123, hours(0), None, "hi_123"))
    push(*[(i, hours(-1), None, "older") for i in (123, 567, 890)])
    assert names(fs, [123, 567]) == {123: ("hi_123", "PRESENT"), 567: ("older", "PRESENT")}
    push((123, hours(0.1), None, "LATEST"))
    fs.materialize(hours(-2), hours(1), now=hours(2))
    assert {k: v[0] for k, v in names(fs, [123, 567, 890]).items()} == {123: "LATEST", 567: "L2", 890: "L3"}


def test_equal_times_keep_the_stored_row(spark):
    fs = make_store(spark, [])
    for name in ("b", "a", "c"):
        rows = spark.createDataFrame([(1, hours(0), None, name)], SCHEMA)
        fs.write_to_online_store("stats", rows, now=hours(1))
    assert names(fs, [1])[1][0] == "b"
    fs.snapshots.compact("stats", ["driver_id"])
    assert names(fs, [1])[1][0] == "b"


def test_merge_latest(spark):
    schema = f"k int, v string, {EVENT_TS} timestamp_ntz, {CREATED_TS} timestamp_ntz"
    old = spark.createDataFrame([(1, "a", hours(1), None), (2, "b", hours(5), hours(5))], schema)
    new = spark.createDataFrame(
        [(1, "z", hours(1), None), (2, "c", hours(5), hours(6)), (3, "d", hours(0), None)], schema
    )
    got = {r["k"]: r["v"] for r in merge_latest(old, new, ["k"]).collect()}
    assert got == {1: "a", 2: "c", 3: "d"}


def test_load_range_has_both_ends_and_can_leave_one_out(spark):
    rows = [(1, hours(0), None, "start"), (2, hours(5), None, "end"), (3, hours(5.01), None, "after")]
    fs = make_store(spark, rows)
    got = fs.pull_latest("stats", hours(0), hours(5)).collect()
    assert {r["driver_id"] for r in got} == {1, 2}
    got = fs.pull_latest("stats", hours(0), hours(5), closed="left").collect()
    assert {r["driver_id"] for r in got} == {1}
    assert fs.pull_all("stats", hours(0), hours(9)).count() == 3


def test_null_of_the_latest_row_is_loaded(spark):
    rows = [(1, hours(-4), None, "0.1"), (1, hours(-3), None, "0.3"), (2, hours(0), None, None), (3, hours(-4), None, "4")]
    fs = make_store(spark, [*rows, (3, hours(-1), None, "5")], ttl=timedelta(days=5))
    fs.materialize(hours(-10), hours(-1.01), now=hours(0))
    assert names(fs, [1, 2, 3], hours(0)) == {
        1: ("0.3", "PRESENT"), 2: (None, "NOT_FOUND"), 3: ("4", "PRESENT"),
    }
    fs.materialize_incremental(hours(0), now=hours(0))
    assert names(fs, [1, 2, 3], hours(0)) == {
        1: ("0.3", "PRESENT"), 2: (None, "NULL_VALUE"), 3: ("5", "PRESENT"),
    }
    ends = [r["range_end"] for r in fs.snapshots.intervals("stats").orderBy("seq").collect()]
    assert ends == [hours(-1.01), hours(0)]


def test_incremental_start(spark):
    rows = [(1, hours(0), None, "too old"), (2, hours(20), None, "in reach")]
    fs = make_store(spark, rows, ttl=timedelta(hours=10))
    fs.materialize_incremental(hours(25), now=hours(24))
    assert {k: v[0] for k, v in names(fs, [1, 2], hours(24)).items()} == {1: None, 2: "in reach"}
    without = make_store(spark, rows)
    with pytest.raises(TidemarkError):
        without.materialize_incremental(hours(25), now=hours(24))


def test_bad_loads_are_rejected(spark):
    fs = make_store(spark, [])
    with pytest.raises(TidemarkError):
        fs.materialize(hours(2), hours(1))
    fs.apply(FeatureView("offline", [], None, [Feature("x", "int")], online=False))
    with pytest.raises(TidemarkError):
        fs.materialize(hours(0), hours(1), ["offline"])
    with pytest.raises(SourceValidationError):
        fs.write_to_online_store("stats", spark.createDataFrame([(1,)], "driver_id bigint"))


def test_statuses(spark):
    rows = [(1, hours(90), None, "fresh"), (2, hours(10), None, "stale"), (3, hours(95), None, None), (4, hours(10), None, None)]
    fs = make_store(spark, rows, ttl=timedelta(hours=24))
    fs.materialize(hours(0), hours(100), now=hours(100))
    assert names(fs, [1, 2, 3, 4, 5]) == {
        1: ("fresh", "PRESENT"),
        2: ("stale", "OUTSIDE_MAX_AGE"),
        3: (None, "NULL_VALUE"),
        4: (None, "OUTSIDE_MAX_AGE"),
        5: (None, "NOT_FOUND"),
    }


def test_requests_repeat_and_may_use_the_entity_name(spark):
    fs = make_store(spark, [(1, hours(0), None, "a"), (2, hours(0), None, "b")])
    fs.materialize(hours(0), hours(1))
    requests = [{"driver": 1, "n": 0}, {"driver": 2, "n": 1}, {"driver": 1, "n": 2}, {"driver": None, "n": 3}]
    df = fs.get_online_features(["stats:name"], requests, metadata=False)
    assert [tuple(r) for r in df.orderBy("n").collect()] == [
        (1, 0, "a"), (2, 1, "b"), (1, 2, "a"), (None, 3, None),
    ]
    keys = request_keys(df, [("driver_id", "driver_id")])
    assert keys.filter("driver_id IS NOT NULL").count() == 2
    with pytest.raises(MissingSpineColumns):
        fs.get_online_features(["stats:name"], [{"driver": 1}, {"n": 1}])
    with pytest.raises(MissingSpineColumns):
        fs.get_online_features(["stats:name"], [{"n": 1}])


def test_lookup_before_any_load(spark):
    fs = make_store(spark, [])
    assert names(fs, [1]) == {1: (None, "NOT_FOUND")}


def test_few_requests_cut_a_large_snapshot_first(spark, capsys):
    fs = make_store(spark, [(i, hours(i % 5), None, str(i)) for i in range(50)])
    fs.limits = Limits(small_bytes=1000)
    fs.materialize(hours(0), hours(2))
    fs.materialize(hours(2), hours(9))
    df = fs.get_online_features(["stats:name"], [{"driver_id": 7}], metadata=False)
    assert df.collect()[0]["name"] == "7"
    df.explain()
    assert "LeftSemi" in capsys.readouterr().out


def test_folding_keeps_rows(spark):
    fs = make_store(spark, [(i, hours(0), None, "base") for i in range(20_000)])
    fs.materialize(hours(-1), hours(1))
    for n in range(1, 6):
        rows = spark.createDataFrame([(n, hours(n), None, f"push{n}")], SCHEMA)
        fs.write_to_online_store("stats", rows, now=hours(n))
    assert len(fs.snapshots.versions("stats")) == 6
    assert {k: v[0] for k, v in names(fs, [1, 5, 9]).items()} == {1: "push1", 5: "push5", 9: "base"}
    fs.snapshots.compact("stats", ["driver_id"])
    assert len(fs.snapshots.versions("stats")) == 1
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 20_000


def test_keys_expire_after_their_last_write(spark):
    fs = make_store(spark, [(1, hours(0), None, "a"), (2, hours(0), None, "b")], key_ttl=timedelta(hours=5))
    fs.materialize(hours(0), hours(1), now=hours(1))
    rows = spark.createDataFrame([(2, hours(3), None, "c")], SCHEMA)
    fs.write_to_online_store("stats", rows, now=hours(4))
    assert {k: v[1] for k, v in names(fs, [1, 2], hours(7)).items()} == {1: "NOT_FOUND", 2: "PRESENT"}
    fs.snapshots.purge("stats", ["driver_id"], timedelta(hours=5), hours(7))
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 1


def test_dropped_views_start_over(spark):
    fs = make_store(spark, [(1, hours(0), None, "a")], ttl=timedelta(hours=1))
    fs.materialize(hours(0), hours(5), now=hours(5))
    fs.snapshots.drop("stats")
    assert fs.snapshots.read("stats", ["driver_id"]) is None
    assert fs.snapshots.last_end("stats") is None
    fs.materialize(hours(0), hours(5), now=hours(5))
    assert fs.snapshots.last_end("stats") == hours(5)
    fs.remove_view("stats")
    assert fs.drop_unused_snapshots() == []


def test_without_entities(spark):
    frame = spark.createDataFrame([(hours(0), 1), (hours(5), 2)], "ts timestamp_ntz, rides int")
    fs = FeatureStore(spark)
    fs.apply(FeatureView("world", [], FrameSource(name="w", df=frame, event_timestamp_column="ts")))
    fs.materialize(hours(0), hours(3))
    assert fs.snapshots.read("world", [DUMMY_KEY]).count() == 1
    fs.materialize(hours(3), hours(9))
    df = fs.get_online_features(["world:rides"], [{"n": 1}, {"n": 2}], metadata=False)
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2), (2, 2)]


def test_latest_without_rows_or_keys(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pull_latest(empty, [], ["name"], "ts").count() == 0
    assert pull_latest(empty, ["driver_id"], ["name"], "ts").count() == 0
    maps = spark.sql("SELECT 1 AS k, 1 AS t, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)")
    assert latest_per_key(maps, ["k"], ["t"]).first()["m"] == {"b": 2}


def test_latest_sends_one_row_per_key_and_task(spark, capsys):
    df = spark.createDataFrame([(1, hours(0), None, "a")], SCHEMA)
    latest_per_key(df, ["driver_id"], ["ts"]).explain()
    plan = capsys.readouterr().out
    assert "partial_max" in plan and "Window" not in plan


def test_push_source_feeds_its_views(spark):
    frame = spark.createDataFrame([(1, hours(0), None, "batch")], SCHEMA)
    push = PushSource(
        name="events",
        schema={"id": "bigint", "ts": "timestamp_ntz", "name": "string"},
        event_timestamp_column="ts",
        field_mapping={"id": "driver_id"},
        batch_source=FrameSource(name="s", df=frame, event_timestamp_column="ts", created_timestamp_column="created"),
    )
    view = FeatureView("stats", ["driver"], None, [Feature("name", "string")], stream_source=push)
    fs = FeatureStore(spark)
    fs.apply(DRIVER, push, view)
    rows = spark.createDataFrame([(1, hours(2), "pushed")], "id bigint, ts timestamp_ntz, name string")
    fs.push("events", rows, now=hours(3))
    fs.materialize(hours(0), hours(1), now=hours(4))
    assert names(fs, [1])[1][0] == "pushed"
    with pytest.raises(TidemarkError):
        fs.push("other", rows)


def test_pushed_pandas_rows_take_the_declared_types(spark):
    import pandas as pd

    fs = FeatureStore(spark)
    view = FeatureView("v", ["driver"], None, [Feature("n", "int"), Feature("x", "float")])
    fs.apply(DRIVER, view)
    rows = pd.DataFrame({"driver_id": [1], "n": [5], "x": [0.5], "event_timestamp": [hours(0)]})
    fs.write_to_online_store("v", rows, now=hours(1))
    fs.write_to_online_store("v", rows.assign(n=6, event_timestamp=hours(2)), now=hours(3))
    stored = fs.snapshots.read("v", ["driver_id"])
    assert [stored.schema[c].dataType.simpleString() for c in ("driver_id", "n", "x")] == ["bigint", "int", "float"]
    row = stored.first()
    assert (row["n"], row[EVENT_TS]) == (6, hours(2))
    with pytest.raises(TidemarkError):
        fs.write_to_online_store("v", rows.assign(n="text"), now=hours(1))


def test_repeated_stream_batch_replaces_itself(spark):
    fs = make_store(spark, [])
    rows = spark.createDataFrame([(1, hours(0), None, "a")], SCHEMA)
    for _ in range(2):
        fs.write_to_online_store("stats", rows, now=hours(1), version="q-000")
    assert len(fs.snapshots.versions("stats")) == 1
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 1


def test_a_replay_disturbs_no_reader_and_survives_a_drop(spark):
    fs = make_store(spark, [])
    rows = spark.createDataFrame([(1, hours(0), None, "a")], SCHEMA)
    fs.write_to_online_store("stats", rows, now=hours(1), version="q-1")
    held = fs.snapshots.read("stats", ["driver_id"])
    fs.write_to_online_store("stats", rows, now=hours(1), version="q-1")
    assert held.count() == 1
    fs.snapshots.drop("stats")
    assert fs.snapshots.read("stats", ["driver_id"]) is None
    fs.write_to_online_store("stats", rows, now=hours(1), version="q-1")
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 1


def test_a_replay_stays_older_than_loads_after_its_first_run(spark):
    fs = make_store(spark, [])
    for name, version in (("first", "q-1"), ("second", "q-2"), ("first again", "q-1")):
        fs.write_to_online_store("stats", spark.createDataFrame([(1, hours(0), None, name)], SCHEMA), hours(1), version)
    assert names(fs, [1])[1][0] == "first again"


def test_a_fold_during_a_drop_brings_nothing_back(spark):
    fs = make_store(spark, [])
    for n in range(2):
        rows = spark.createDataFrame([(1, hours(n), None, "a")], SCHEMA)
        fs.write_to_online_store("stats", rows, now=hours(1))
    live = fs.snapshots.versions("stats")
    merged = fs.snapshots._merged("stats", live, ["driver_id"])
    fs.snapshots.drop("stats")
    fs.snapshots._replace("stats", merged, live)
    assert fs.snapshots.read("stats", ["driver_id"]) is None


def test_lookup_names_must_not_collide_and_order_is_kept(spark):
    fs = make_store(spark, [(i, hours(0), None, str(i)) for i in range(50)])
    fs.materialize(hours(-1), hours(1))
    taken = spark.createDataFrame([(1, "x")], "driver_id bigint, name string")
    for metadata in (True, False):
        with pytest.raises(FeatureNameCollision):
            fs.get_online_features(["stats:name"], taken, metadata=metadata)
    with pytest.raises(FeatureNameCollision):
        fs.get_online_features(["stats:name"], taken.withColumnRenamed("name", "name__status"))
    asked = [(i * 37) % 60 for i in range(120)]
    df = fs.get_online_features(["stats:name"], [{"driver_id": i} for i in asked], metadata=False, ordered=True)
    assert [r["driver_id"] for r in df.collect()] == asked


def test_stream_restarts_and_new_streams_lose_nothing(spark, tmp_path):
    fs = make_store(spark, [])
    folder = str(tmp_path / "in")

    def feed(key, hour, name):
        spark.createDataFrame([(key, hours(hour), None, name)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def run(checkpoint):
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        fs.push_stream("stats", str(tmp_path / checkpoint), stream, now=hours(9)).awaitTermination()

    feed(1, 1, "a")
    run("c1")
    feed(1, 0, "late")
    feed(2, 2, "b")
    run("c1")
    run("c2")
    assert {k: v[0] for k, v in names(fs, [1, 2]).items()} == {1: "a", 2: "b"}
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 2


def test_reader_options():
    kafka = KafkaSource(name="k", bootstrap_servers="host:9092", topic="t", options={"startingOffsets": "earliest"})
    assert kafka.reader() == (
        "kafka",
        {"kafka.bootstrap.servers": "host:9092", "subscribe": "t", "startingOffsets": "earliest"},
    )
    kinesis = KinesisSource(name="k", region="eu", stream_name="s")
    assert kinesis.reader() == ("kinesis", {"region": "eu", "streamName": "s"})


def test_json_payload(spark):
    source = StreamSource(payload_format="json", payload_schema="a bigint, b string", field_mapping={"b": "name"})
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("broken",)], "value string")
    assert [tuple(r) for r in source.decode(df).collect()] == [(1, "x"), (None, None)]
    with pytest.raises(ValueError):
        StreamSource(payload_format="xml").decode(df)


def test_missing_add_ons_are_named(spark, tmp_path):
    descriptor = tmp_path / "none.desc"
    descriptor.write_bytes(b"")
    df = spark.createDataFrame([(bytearray(b"x"),)], "value binary")
    record = '{"type": "record", "name": "r", "fields": [{"name": "a", "type": "long"}]}'
    for kind, schema, options in (("avro", record, {}), ("protobuf", "Message", {"descriptor": str(descriptor)})):
        source = StreamSource(payload_format=kind, payload_schema=schema, payload_options=options)
        with pytest.raises(SourceValidationError, match=f"spark-{kind}"):
            source.decode(df)


def test_spread_of_null_keys_does_not_change_lookups(spark):
    fs = make_store(spark, [(None, hours(0), None, "nobody"), (1, hours(0), None, "a")])
    fs.materialize(hours(0), hours(1))
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 1
    df = fs.get_online_features(["stats:name"], spark.range(3).select(F.col("id").alias("driver_id")))
    assert df.filter("name IS NOT NULL").count() == 1
