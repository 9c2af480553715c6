"""Work that must not be repeated, nor meet in one task, as tables grow."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import T0, hours, naive_asof
from tests.test_asof import FEATURES, SPINE, joined, side
from tidemark import Entity, Feature, FeatureService, FeatureStore, FeatureView, FrameSource
from tidemark.operators.asof import AsofSide, asof_join
from tidemark.plans.keys import few_points
from tidemark.plans.sizes import Limits

LARGE = Limits(small_bytes=0)


def counted_spine(spark, n):
    """Rows of two keys whose making is counted."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def key(i):
        made.add(1)
        return i % 5

    ids = spark.range(n, numPartitions=2)
    return made, ids.select(
        F.col("id").alias("row"), key("id").alias("a"), (F.col("id") % 3).alias("b"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") % 7).cast("int"))).alias("ts"),
    )


def two_ways(spark, tmp_path):
    """A view asked for under two keys, in a store that takes nothing for small."""
    rows = [(k, hours(h), 10 * k + h) for k in range(5) for h in range(0, 7, 2)]
    source = FrameSource(name="x", df=spark.createDataFrame(rows, "k bigint, ets timestamp_ntz, v bigint"), event_timestamp_column="ets")
    view = FeatureView("x", ["k"], source, [Feature("v", "bigint")], timedelta(hours=1))
    service = FeatureService("both", [view.with_name(n).with_join_key_map({"k": n}) for n in ("a", "b")])
    fs = FeatureStore(spark, root=str(tmp_path), limits=LARGE)
    fs.apply([Entity("k", "bigint", "k")], view, service)
    return fs, service


def test_planning_makes_a_large_spine_once(spark, tmp_path):
    fs, service = two_ways(spark, tmp_path)
    made, spine = counted_spine(spark, 3000)
    found = fs.get_historical_features(spine, service, True, prune=True, prune_keys=True).df
    assert made.value == 3000
    plan = found._jdf.queryExecution().toString()
    assert "InMemory" not in plan  # what was stored for planning is not needed later
    for row in found.collect():
        hour = row["row"] % 7
        for key in ("a", "b"):
            fresh = 10 * row[key] + hour - hour % 2
            assert row[f"{key}__v"] == fresh


def test_a_stored_spine_of_the_caller_stays_stored(spark, tmp_path):
    fs, service = two_ways(spark, tmp_path)
    spine = counted_spine(spark, 300)[1].select("ts", "a", "b").persist()
    fs.get_historical_features(spine, service, True).df.count()
    assert spine.storageLevel.useMemory
    spine.unpersist()


def few_keys(n=4000):
    spine = [(None if i % 11 == 0 else i % 3, None if i % 13 == 0 else hours(i % 8), i) for i in range(n)]
    features = [(k, hours(h + 0.5), hours(h), 10 * h + k) for k in (0, 1, 2, 3) for h in range(-3, 8, 2)]
    return spine, features


@pytest.mark.parametrize("ttl", [None, timedelta(minutes=40)])
def test_few_points_are_looked_up_without_a_shuffle_of_the_spine(spark, ttl):
    spine, features = few_keys()
    found = asof_join(
        spark.createDataFrame(spine, SPINE), "ts", [side(spark.createDataFrame(features, FEATURES), ttl=ttl)], limits=LARGE
    )
    assert joined(found) == Counter(naive_asof(spine, features, ttl))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan.splitlines()[:6]
    assert any("Join LeftOuter" in line and "broadcast" in line for line in above), plan


def test_many_points_or_a_low_bound_give_none(spark):
    rows = spark.createDataFrame(few_keys()[0], SPINE)
    assert few_points(rows, ["key", "ts"], LARGE).count() == 24
    assert few_points(rows, ["key", "ts"], Limits(few_points=5)) is None
    assert few_points(rows, ["row_id"], LARGE) is None


def test_the_event_time_is_left_out_where_not_wanted(spark):
    spine, features = few_keys(50)
    frame = spark.createDataFrame(features, FEATURES)
    lean = AsofSide("hit", frame, "ets", ("value",), (("key", "key"),), "created", timedelta(hours=5), timed=False)
    found = asof_join(spark.createDataFrame(spine, SPINE), "ts", [lean], "window")
    assert found.schema["hit"].dataType.names == ["value"]
    want = Counter((*r[:3], r[4]) for r in naive_asof(spine, features, timedelta(hours=5)))
    assert Counter(tuple(r) for r in found.select("key", "ts", "row_id", "hit.value").collect()) == want
