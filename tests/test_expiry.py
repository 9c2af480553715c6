"""Keys that end in a stream."""

from __future__ import annotations

from datetime import timedelta

import pytest

from tests.frames import hours
from tests.test_snapshots import SCHEMA, make_store, names
from tidemark.operators.latest import REMOVED_AT
from tidemark.streaming.expiry import ROCKSDB, _Expiring, expiring_stream
from workloads.serving import _files_a_week

SETTING = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocksdb(spark):
    spark.conf.set(SETTING, ROCKSDB)
    yield
    spark.conf.unset(SETTING)


class Feed:
    """A folder of files and the changes of a stream over it, one file a batch."""

    def __init__(self, spark, folder, ttl=5, delay="1 hour"):
        self.spark, self.folder, self.ttl, self.delay = spark, str(folder), timedelta(hours=ttl), delay

    def put(self, *rows):
        frame = self.spark.createDataFrame([(k, hours(h), None, name) for k, h, name in rows], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")

    def run(self):
        found = []
        changes = expiring_stream(self.stream(), ["driver_id"], "ts", self.ttl, self.delay, "created")
        query = (
            changes.writeStream.outputMode("update")
            .foreachBatch(lambda batch, _: found.extend(batch.collect()))
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sorted((r["driver_id"], r["name"], r[REMOVED_AT]) for r in found if r[REMOVED_AT]), {
            r["driver_id"]: r["name"] for r in found if not r[REMOVED_AT]
        }


def test_gaps_within_and_between_batches_and_restarts(spark, tmp_path, rocksdb):
    feed = Feed(spark, tmp_path)
    feed.put((1, 0, "a"), (1, 7, "b"), (2, 0, "c"), (3, 7, "d"), (3, 7, "e"))
    # a gap in the batch, and key 2 by the watermark at hour 6
    assert feed.run() == ([(1, "a", hours(5)), (2, "c", hours(5))], {1: "b", 2: "c", 3: "e"})
    feed.put((1, 11.9, "f"))
    feed.put((4, 20, "g"), (2, 20, "h"))
    # the state outlives the restart: 3 ended at 12, 1 at 16.9
    removed, newest = feed.run()
    assert removed == [(1, "f", hours(16.9)), (3, "e", hours(12))] and newest == {1: "f", 2: "h", 4: "g"}
    assert feed.run() == ([], {})


def test_an_older_row_changes_nothing(spark, tmp_path, rocksdb):
    feed = Feed(spark, tmp_path, delay="10 hours")
    feed.put((1, 5, "new"))
    feed.put((1, 3, "old"))
    assert feed.run() == ([], {1: "new"})


def test_a_removed_key_leaves_the_snapshot_and_may_come_back(spark, tmp_path, rocksdb):
    fs, feed = make_store(spark, []), Feed(spark, tmp_path)

    def push():
        fs.push_stream(
            "stats", str(tmp_path / "push"), feed.stream(), now=hours(50), key_ttl=timedelta(hours=5), delay="1 hour"
        ).awaitTermination()

    feed.put((1, 0, "a"), (2, 6.5, "b"))
    push()
    assert {k: v[1] for k, v in names(fs, [1, 2]).items()} == {1: "NOT_FOUND", 2: "PRESENT"}
    # a late row from elsewhere does not bring it back, neither before nor after a fold
    fs.write_to_online_store("stats", spark.createDataFrame([(1, hours(1), None, "late")], SCHEMA), now=hours(51))
    fs.snapshots.compact("stats", ["driver_id"])
    assert names(fs, [1])[1] == (None, "NOT_FOUND")
    feed.put((1, 10, "again"))
    push()
    assert {k: v[0] for k, v in names(fs, [1, 2]).items()} == {1: "again", 2: "b"}


def test_other_state_stores_are_refused(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put((1, 0, "a"))
    with pytest.raises(ValueError, match="RocksDB"):
        expiring_stream(feed.stream(), ["driver_id"], "ts", timedelta(hours=1), "1 hour")


def test_a_key_is_asked_for_once_a_batch_and_has_one_timer():
    """The calls to the state: they are what a key costs."""
    calls = []

    class Held:
        row = None

        def exists(self):
            calls.append("exists")
            return self.row is not None

        def get(self):
            calls.append("get")
            return self.row

        def update(self, row):
            calls.append("update")
            self.row = row

        def clear(self):
            calls.append("clear")
            self.row = None

    class Handle:
        timers = []

        def getValueState(self, *_):
            return Held()

        def listTimers(self):
            calls.append("list")
            return iter(list(self.timers))

        def deleteTimer(self, at):
            calls.append("delete")
            self.timers.remove(at)

        def registerTimer(self, at):
            calls.append("register")
            self.timers.append(at)

    class Watermark:
        at = 0

        def getCurrentWatermarkInMs(self):
            return self.at

    def rows(*seconds):
        return iter([{"__ft_time": s * 1_000_000, "rank": "", "__ft_kept": str(s)} for s in seconds])

    def taken():
        found = list(calls)
        calls.clear()
        return found

    processor, handle, clock = _Expiring(timedelta(seconds=10)), Handle(), Watermark()
    processor.init(handle)
    assert len(list(processor.handleInputRows((1,), rows(0), clock))) == 1 and taken() == ["get", "update", "register"]
    assert len(list(processor.handleInputRows((1,), rows(5, 8), clock))) == 1 and taken() == ["get", "update"]
    assert list(processor.handleInputRows((1,), rows(3), clock)) == [] and taken() == ["get"]
    # the timer of the first row comes too early for the newest
    clock.at = 10_001
    handle.timers.remove(10_000)
    assert list(processor.handleExpiredTimer((1,), clock, None)) == [] and handle.timers == [18_000]
    clock.at = 18_000
    assert list(processor.handleExpiredTimer((1,), clock, None)) == []
    clock.at = 18_001
    assert [r[REMOVED_AT] for r in processor.handleExpiredTimer((1,), clock, None)] == [18_000_000]
    assert processor.newest.row is None


def test_late_timers_of_keys_written_to_in_every_batch(spark, tmp_path, rocksdb):
    feed = Feed(spark, tmp_path)
    feed.put((1, 0, "a"), (2, 0, "x"))
    feed.put((1, 4, "b"), (2, 5, "y"))
    feed.put((1, 8, "c"), (3, 8, "z"))
    feed.put((3, 12, "w"))
    # the watermark ends at hour 11: 2 ended at 10, and 1 is held until 13
    assert feed.run() == ([(2, "y", hours(10))], {1: "c", 2: "y", 3: "w"})
    feed.put((4, 15, "v"))
    assert feed.run() == ([(1, "c", hours(13))], {4: "v"})


def test_large_weeks_are_several_files():
    assert [_files_a_week(n) for n in (None, 1, 20 * 1024 * 1024, 700_000_000)] == [1, 1, 1, 34]
