"""The log of a view, folding by size class, and buckets of the key."""

from __future__ import annotations

import json
import random
import re
from dataclasses import asdict, replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import hours
from tests.test_snapshots import SCHEMA, make_store, names
from tidemark import snapshot_log
from tidemark.plans.sizes import DEFAULT_LIMITS, Limits
from tidemark.snapshot_log import DROP, FOLD, LOAD, PURGE, Record, State, ViewLog, resolve


def load(seq, folder, version=None, end=None):
    return Record(LOAD, "v", seq, folder, version or folder, seq, seq, range_end=end)


def fold(seq, folder, covers, stamp, kind=FOLD):
    return Record(kind, "v", seq, folder, folder, seq, stamp, tuple(covers))


def live(records, before=State()):
    return [r.folder for r in resolve(records, before).live]


def test_order_of_arrival_does_not_matter():
    records = [load(1, "a"), load(2, "b"), load(3, "c"), fold(2, "ab", "ab", 10), load(4, "d", "c"), Record(DROP, "v", 0)]
    records += [fold(4, "all", ["ab", "d"], 12), load(5, "e", end="2024-01-01T00:00:00")]
    draw = random.Random(1)
    for _ in range(50):
        draw.shuffle(records)
        # the second load of version c takes the place of the first
        assert live(records) == ["all", "e"]
        cut = draw.randrange(len(records) + 1)
        held, seen = resolve(records[:cut]), {x.folder for x in records[:cut]}
        # a summary knows no folder it has seen the end of, so what a fold stands on comes before it
        if all(set(r.covers) <= seen for r in records[:cut]) and ("all" not in seen or "c" in seen):
            assert live(records[cut:], held) == ["all", "e"]


def test_folds_that_conflict():
    loads = [load(1, "a"), load(2, "b"), load(3, "c")]
    # of two folds of the same folders the first counts, and nothing built on the other
    assert live([*loads, fold(2, "x", "ab", 10), fold(3, "y", "bc", 11), fold(3, "z", ["y"], 12)]) == ["x", "c"]
    # a purge wins, whenever it was written
    for stamp in (5, 50):
        purge = fold(2, "p", "ab", stamp, PURGE)
        assert live([*loads, fold(2, "x", "ab", 10), purge]) == ["p", "c"]
        assert live([*loads, fold(2, "x", "ab", 10), fold(3, "y", ["x", "c"], 11), purge]) == ["p", "c"]
    # a drop covers what was numbered before it; a fold with older folders falls apart
    drop = Record(DROP, "v", 2)
    assert live([*loads, drop]) == ["c"]
    assert live([*loads, fold(3, "y", "bc", 11), drop]) == ["c"]
    assert live([*loads, fold(3, "y", "bc", 11), Record(DROP, "v", 3)]) == []


def test_last_end_survives_drops_and_summaries():
    ends = [load(1, "a", end="2024-01-09"), load(2, "b", end="2024-01-03"), load(3, "c", end="2024-01-05")]
    assert resolve(ends).last_end == "2024-01-09"
    held = resolve(ends)
    assert len(held.ends) == 2  # b was overtaken by c
    assert resolve([Record(DROP, "v", 1)], held).last_end == "2024-01-05"
    assert resolve([Record(DROP, "v", 3)], held).last_end is None


def test_reading_a_long_log_reads_few_files(spark, tmp_path):
    log = ViewLog(spark, str(tmp_path / "log"))
    reads, read = [], log.files.read
    log.files.read = lambda path: reads.append(path) or read(path)
    for n in range(70):
        state = log.state()
        log.append(replace(load(log.next_seq(state), f"f{n}"), rows=1))
        if len(state.live) >= 4:
            covers = [r.folder for r in state.live]
            log.append(fold(state.live[-1].seq, f"fold{n}", covers, 0))
        reads.clear()
        known = {r.folder for r in log.state().live}
        assert len(reads) <= 2 * snapshot_log.EPOCH_RECORDS + 1 and f"f{n}" in known and len(known) <= 6
    rows = log.history()
    assert rows.filter("kind = 'load'").count() == 70 and rows.select("id").distinct().count() == rows.count()


def test_late_records_and_two_summaries_lose_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshot_log, "EPOCH_RECORDS", 3)
    log, other = (ViewLog(spark, str(tmp_path / "log")) for _ in range(2))
    for n in range(3):
        log.append(load(n + 1, f"f{n}"))
    # a writer that looked before the summary was there, and another summary of less
    late = json.dumps(asdict(replace(load(9, "late"), id="late")))
    other.files.add(other._epoch(0), "r-00000000000000000009-late.json", late)
    assert {r.folder for r in log.state().live} == {"f0", "f1", "f2", "late"}
    held = log.files.names(log._epoch(1))
    log.files.add(log._epoch(1), "s-0.json", '{"covered": [], "live": [], "dropped": 0, "ends": [], "last_seq": 0, "ranges": []}')
    assert len(log.files.names(log._epoch(1))) == len(held) + 1
    assert {r.folder for r in log.state().live} == {"f0", "f1", "f2", "late"}
    for n in range(10, 20):
        log.append(load(n, f"f{n}"))
    assert {r.folder for r in log.state().live} == {"f0", "f1", "f2", "late", *(f"f{n}" for n in range(10, 20))}


def test_a_damaged_log_is_not_an_empty_one(spark):
    fs = make_store(spark, [(1, hours(0), None, "a")])
    fs.materialize(hours(0), hours(1))
    log = fs.snapshots._log("stats")
    log.files.add(log._epoch(0), "r-00000000000000000001-x.json", "{broken")
    with pytest.raises(ValueError):
        fs.snapshots.read("stats", ["driver_id"])


def test_pushes_are_folded_by_size_class(spark):
    fs = make_store(spark, [])
    fs.snapshots.fan = 3
    for n in range(12):
        rows = spark.createDataFrame([(n % 5, hours(n), None, f"n{n}")], SCHEMA)
        fs.write_to_online_store("stats", rows, now=hours(n), version=f"q-{n}")
        assert len(fs.snapshots.versions("stats")) <= 2
    assert {k: v[0] for k, v in names(fs, range(5)).items()} == {0: "n10", 1: "n11", 2: "n7", 3: "n8", 4: "n9"}
    # a batch that runs again after it was folded changes nothing
    fs.write_to_online_store("stats", spark.createDataFrame([(4, hours(4), None, "n4")], SCHEMA), now=hours(20), version="q-4")
    assert names(fs, [4])[4][0] == "n9"
    folds = fs.snapshots.log("stats").filter("kind = 'fold'")
    assert folds.count() == 6 and folds.filter("rows > 5").count() == 0


def test_size_classes():
    from tidemark.snapshots import _size_class

    assert [_size_class(n, 8) for n in (0, 10_000, 10_001, 79_999, 80_000, 640_000)] == [0, 0, 1, 1, 2, 3]


def test_a_fold_beside_a_purge_brings_no_key_back(spark):
    fs = make_store(spark, [(1, hours(0), None, "a")], key_ttl=timedelta(hours=5))
    fs.materialize(hours(0), hours(1), now=hours(1))
    fs.write_to_online_store("stats", spark.createDataFrame([(2, hours(3), None, "c")], SCHEMA), now=hours(4))
    fs.key_ttl = None
    began = fs.snapshots.versions("stats")
    folded = fs.snapshots._merged("stats", began, ["driver_id"])
    fs.snapshots.purge("stats", ["driver_id"], timedelta(hours=5), hours(7))
    fs.snapshots._replace("stats", folded, began, ["driver_id"])
    assert [r["driver_id"] for r in fs.snapshots.read("stats", ["driver_id"]).collect()] == [2]


def bucketed(spark, rows=400):
    fs = make_store(spark, [])
    fs.limits = fs.snapshots.limits = Limits(small_bytes=1, bucket_bytes=100)
    keys = spark.range(rows).select(
        F.col("id").alias("driver_id"), F.lit(hours(0)).alias("ts"), F.lit(None).cast("timestamp_ntz").alias("created"),
        F.col("id").cast("string").alias("name"),
    )
    fs.write_to_online_store("stats", keys, now=hours(1))
    return fs


def test_lookups_read_only_the_buckets_of_their_keys(spark, capsys):
    fs = bucketed(spark)
    (record,) = fs.snapshots.versions("stats")
    assert record.buckets >= 16 and record.rows == 400
    fs.write_to_online_store("stats", spark.createDataFrame([(3, hours(5), None, "new")], SCHEMA), now=hours(5))
    asked = spark.createDataFrame([(3,), (70,), (9999,), (None,)], "driver_id int")
    read = fs.snapshots.read("stats", ["driver_id"], asked, fs.limits)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    read.explain()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    (buckets,) = re.findall(r"__ft_bucket#\d+ IN \(([^)]*)\)", capsys.readouterr().out)
    # one for each key asked for, and for null
    assert len(buckets.split(",")) <= 4
    assert {r["driver_id"]: r["name"] for r in read.collect()} == {3: "new", 70: "70"}
    found = fs.get_online_features(["stats:name"], asked, metadata=False)
    assert {r["driver_id"]: r["name"] for r in found.collect()} == {3: "new", 70: "70", 9999: None, None: None}
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 400
    fs.snapshots.compact("stats", ["driver_id"])
    assert fs.snapshots.versions("stats")[0].buckets >= 2
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 400


def test_keys_of_another_kind_read_all_buckets(spark):
    fs = bucketed(spark)
    asked = spark.createDataFrame([("7",), ("07",)], "driver_id string")
    found = fs.get_online_features(["stats:name"], asked, metadata=False)
    assert [r["name"] for r in found.collect()] == ["7", "7"]


def test_the_log_counts_rows_and_knows_the_latest_time(spark):
    fs = make_store(spark, [(1, hours(0), None, "a"), (1, hours(3), None, "b"), (2, hours(1), None, "c"), (None, hours(9), None, "d")])
    fs.materialize(hours(0), hours(10))
    fs.materialize(hours(20), hours(30))
    rows = fs.snapshots.log("stats").orderBy("seq").select("rows", "latest", "buckets").collect()
    assert [tuple(r) for r in rows] == [(2, hours(3), 1), (0, None, 1)]
    assert DEFAULT_LIMITS.max_buckets & (DEFAULT_LIMITS.max_buckets - 1) == 0


def span(seq, first, last, is_open=False):
    at = [hours(h).isoformat() for h in (first, last)]
    return replace(load(seq, f"s{seq}"), range_start=at[0], range_end=at[1], range_open=is_open)


def test_ranges_are_joined_and_forgotten():
    records = [span(1, 0, 5), span(2, 5, 6, True), span(3, 8, 9), span(4, 8.5, 8.7), span(5, 20, 21)]
    iso = lambda h: hours(h).isoformat()
    joined = ((iso(0), iso(6), True, 1), (iso(8), iso(9), False, 3), (iso(20), iso(21), False, 5))
    draw = random.Random(4)
    for _ in range(20):
        draw.shuffle(records)
        cut = draw.randrange(len(records) + 1)
        assert resolve(records[cut:], resolve(records[:cut])).ranges == joined
    held = resolve(records)
    assert resolve([Record(DROP, "v", 4)], held).ranges == joined[2:]
    assert resolve([span(9, 6, 6)], held).ranges[0] == (iso(0), iso(6), False, 1)


def test_missing_ranges_are_what_is_loaded(spark):
    fs = make_store(spark, [(h, hours(h), None, str(h)) for h in range(30)])
    assert fs.missing_ranges("stats", hours(0), hours(29)) == [(hours(0), hours(29))]
    fs.materialize(hours(3), hours(7))
    fs.materialize(hours(7), hours(10), closed="left")
    fs.materialize(hours(15), hours(20))
    assert fs.missing_ranges("stats", hours(0), hours(29)) == [
        (hours(0), hours(3)), (hours(10), hours(15)), (hours(20), hours(29))
    ]
    assert fs.missing_ranges("stats", hours(4), hours(9)) == [] and fs.missing_ranges("stats", hours(16), hours(20)) == []
    # the end that was left out is missing still
    assert fs.missing_ranges("stats", hours(4), hours(10)) == [(hours(10), hours(10))]
    before = fs.snapshots.log("stats").count()
    fs.materialize(hours(0), hours(20), missing_only=True)
    assert fs.snapshots.log("stats").count() == before + 2
    assert fs.snapshots.read("stats", ["driver_id"]).count() == 21
    fs.materialize(hours(0), hours(20), missing_only=True)
    assert fs.snapshots.log("stats").count() == before + 2
    fs.snapshots.drop("stats")
    assert fs.missing_ranges("stats", hours(4), hours(9)) == [(hours(4), hours(9))]
