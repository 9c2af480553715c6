"""The point-in-time join in all its plan shapes, against a row-by-row answer."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import T0, hours, naive_asof, random_rows
from tidemark.operators.asof import AsofSide, asof_join
from tidemark.plans.sizes import Limits, is_small
from tidemark.plans.skew import draw_sample, find_skew, with_slice

SPINE = "key bigint, ts timestamp_ntz, row_id bigint"
FEATURES = "key bigint, ets timestamp_ntz, created timestamp_ntz, value bigint"
TINY = Limits(small_bytes=0, group_rows=20, sample_rows=100_000)


def joined(df):
    rows = df.select("key", "ts", "row_id", "hit.event_timestamp", "hit.value").collect()
    return Counter(tuple(r) for r in rows)


def side(df, keys=(("key", "key"),), ttl=None, created="created", name="hit"):
    return AsofSide(name, df, "ets", ("value",), keys, created, ttl)


@pytest.mark.parametrize("plan,limits", [
    ("window", Limits()), ("points", Limits()), ("sliced", TINY), ("auto", TINY), ("auto", Limits()),
])
@pytest.mark.parametrize("ttl", [None, timedelta(hours=5), timedelta(0)])
def test_against_plain_scan(spark, plan, limits, ttl):
    spine, features = random_rows(seed=hash(str(ttl)) % 1000)
    got = joined(
        asof_join(
            spark.createDataFrame(spine, SPINE),
            "ts",
            [side(spark.createDataFrame(features, FEATURES), ttl=ttl)],
            plan,
            limits,
        )
    )
    assert got == Counter(naive_asof(spine, features, ttl))


@pytest.mark.parametrize("plan,limits", [
    ("window", Limits()), ("points", Limits()), ("sliced", TINY), ("auto", Limits()), ("auto", TINY),
])
@pytest.mark.parametrize("ttl", [None, timedelta(hours=3)])
def test_without_keys(spark, plan, limits, ttl):
    spine, features = random_rows(seed=5)
    one_line = [(0, *f[1:]) for f in features]
    want = Counter(
        (row[0], *r[1:]) for row, r in zip(spine, naive_asof([(0, *s[1:]) for s in spine], one_line, ttl))
    )
    got = joined(
        asof_join(
            spark.createDataFrame(spine, SPINE),
            "ts",
            [side(spark.createDataFrame(features, FEATURES), keys=(), ttl=ttl)],
            plan,
            limits,
        )
    )
    assert got == want


def test_later_created_wins_within_one_event_time_only(spark):
    features = [
        (1001, hours(0), hours(0), 10),
        (1001, hours(0), hours(24), 20),
        (1002, hours(0), hours(24), 30),
        (1002, hours(24), hours(0), 40),
    ]
    spine = [(1001, hours(48), 0), (1002, hours(48), 1)]
    for plan in ("window", "points"):
        df = asof_join(
            spark.createDataFrame(spine, SPINE),
            "ts",
            [side(spark.createDataFrame(features, FEATURES))],
            plan,
        )
        assert {r["key"]: r["hit"]["value"] for r in df.collect()} == {1001: 20, 1002: 40}


def test_both_ends_of_the_age_limit_belong_to_it(spark):
    features = [(1, hours(0), None, 7)]
    spine = [(1, hours(0), 0), (1, hours(5), 1), (1, hours(5.001), 2), (1, hours(-1), 3)]
    df = asof_join(
        spark.createDataFrame(spine, SPINE),
        "ts",
        [side(spark.createDataFrame(features, FEATURES), ttl=timedelta(hours=5))],
    )
    assert {r["row_id"]: bool(r["hit"]) for r in df.collect()} == {0: True, 1: True, 2: False, 3: False}


def test_null_value_of_the_latest_row_stays_null(spark):
    features = [(1, hours(0), None, 7), (1, hours(1), None, None)]
    df = asof_join(
        spark.createDataFrame([(1, hours(2), 0)], SPINE),
        "ts",
        [side(spark.createDataFrame(features, FEATURES))],
    )
    hit = df.first()["hit"]
    assert hit["event_timestamp"] == hours(1) and hit["value"] is None


def test_duplicate_spine_rows_stay(spark):
    df = asof_join(
        spark.createDataFrame([(1, hours(2), 0)] * 3, SPINE),
        "ts",
        [side(spark.createDataFrame([(1, hours(0), None, 7)], FEATURES))],
    )
    assert [r["hit"]["value"] for r in df.collect()] == [7, 7, 7]


def test_composite_keys(spark):
    spine = spark.createDataFrame(
        [("1", "23", hours(1)), ("12", "3", hours(1)), ("1", None, hours(1))],
        "a string, b string, ts timestamp_ntz",
    )
    features = spark.createDataFrame(
        [("1", "23", hours(0), 1), ("12", "3", hours(0), 2)],
        "x string, y string, ets timestamp_ntz, value bigint",
    )
    keys = (("a", "x"), ("b", "y"))
    for plan in ("window", "points"):
        df = asof_join(spine, "ts", [side(features, keys, created=None)], plan)
        got = {(r["a"], r["b"]): r["hit"] and r["hit"]["value"] for r in df.collect()}
        assert got == {("1", "23"): 1, ("12", "3"): 2, ("1", None): None}


def test_zoned_and_zoneless_times_meet_in_utc(spark):
    spine = spark.createDataFrame([(1, T0.isoformat())], "key bigint, s string").select(
        "key", F.to_timestamp(F.concat("s", F.lit("+01:00"))).alias("ts"), F.lit(0).alias("row_id")
    )
    features = spark.createDataFrame(
        [(1, hours(-1), None, 1), (1, hours(0), None, 2)], FEATURES
    )
    hit = asof_join(spine, "ts", [side(features)]).first()["hit"]
    assert hit["value"] == 1


@pytest.mark.parametrize("spine_key,feature_key", [("int", "bigint"), ("bigint", "int"), ("bigint", "string"), ("string", "string")])
def test_key_types_may_differ(spark, spine_key, feature_key):
    spine, features = random_rows(seed=31)
    s = spark.createDataFrame(spine, SPINE).withColumn("key", F.col("key").cast(spine_key))
    f = spark.createDataFrame(features, FEATURES).withColumn("key", F.col("key").cast(feature_key))
    for plan, limits in (("window", Limits()), ("points", Limits()), ("sliced", TINY)):
        df = asof_join(s, "ts", [side(f)], plan, limits)
        assert df.schema["key"].dataType.simpleString() == spine_key
        got = joined(df.withColumn("key", F.col("key").cast("bigint")))
        assert got == Counter(naive_asof(spine, features))


def test_dates_as_spine_and_feature_times(spark):
    spine = spark.sql("SELECT 1L AS key, date'2024-01-02' AS ts, 0L AS row_id")
    features = spark.createDataFrame([(1, hours(24), None, 1), (1, hours(25), None, 2)], FEATURES)
    for plan in ("window", "points"):
        row = asof_join(spine, "ts", [side(features)], plan).first()
        assert row["hit"]["value"] == 1 and str(row["ts"]) == "2024-01-02"
    by_date = features.withColumn("ets", F.col("ets").cast("date"))
    late = spark.createDataFrame([(1, hours(24.5), 0)], SPINE)
    assert asof_join(late, "ts", [side(by_date)]).first()["hit"]["value"] == 2


def test_views_sharing_keys_share_a_shuffle(spark, capsys):
    spine, features = random_rows(seed=9)
    f = spark.createDataFrame(features, FEATURES)
    sides = [side(f, name="a"), side(f, name="b", ttl=timedelta(hours=2)), side(f, keys=(("row_id", "key"),), name="c")]
    df = asof_join(spark.createDataFrame(spine, SPINE), "ts", sides, "window")
    df.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 2
    assert "Join" not in plan
    by_id = naive_asof([(s[2], s[1], s[2]) for s in spine], features)
    want = Counter((r[2], r[4]) for r in by_id)
    got = Counter((r["row_id"], r["c"] and r["c"]["value"]) for r in df.collect())
    assert got == want


def _skewed(spark, n=6000):
    """A third of all rows on one key, half of those at one single moment."""
    ids = spark.range(n)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1)
    at = F.when(F.col("id") % 6 == 0, F.lit(1000)).otherwise((F.col("id") * 37) % 5000)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    ts = start + F.make_dt_interval(F.lit(0), F.lit(0), at.cast("int"))
    rows = ids.select(key.alias("key"), ts.alias("ts"), F.col("id").alias("row_id"))
    features = ids.select(
        key.alias("key"),
        (ts - F.expr("INTERVAL 7 MINUTE")).alias("ets"),
        ts.alias("created"),
        (F.col("id") * 13 % 997).alias("value"),
    )
    return rows, features


@pytest.mark.parametrize("ttl", [None, timedelta(minutes=30)])
def test_hot_key_and_hot_moment(spark, ttl):
    rows, features = _skewed(spark)
    limits = Limits(small_bytes=0, group_rows=300, sample_rows=100_000)
    points = rows.select("key", "ts").unionByName(features.select("key", F.col("ets").alias("ts")))
    skew = find_skew(points, ["key"], "ts", limits)
    assert len(skew.hot) == 1 and skew.tied and skew.slices > 2
    plain = joined(asof_join(rows, "ts", [side(features, ttl=ttl)], "window"))
    assert joined(asof_join(rows, "ts", [side(features, ttl=ttl)], "auto", limits)) == plain
    assert sum(plain.values()) == rows.count()


def test_hot_key_is_cut_into_bounded_groups(spark):
    rows, features = _skewed(spark)
    rows = rows.filter("row_id % 6 != 0")
    features = features.filter("created != timestamp_ntz'2024-01-01 16:40:00'")
    limits = Limits(small_bytes=0, group_rows=200, sample_rows=100_000)
    points = rows.select("key", "ts").unionByName(features.select("key", F.col("ets").alias("ts")))
    skew = find_skew(points, ["key"], "ts", limits)
    assert not skew.tied
    hot = with_slice(points, ["key"], "ts", skew, "s").filter("s >= 0")
    largest = hot.groupBy("key", "s").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * limits.group_rows
    plain = joined(asof_join(rows, "ts", [side(features)], "window"))
    assert joined(asof_join(rows, "ts", [side(features)], "auto", limits)) == plain


def test_map_values_are_carried(spark):
    features = spark.sql(
        "SELECT 1L AS key, timestamp_ntz'2024-01-01' AS ets, map('a', 1) AS value "
        "UNION ALL SELECT 1L, timestamp_ntz'2024-01-02', map('b', 2)"
    )
    spine = spark.createDataFrame([(1, hours(30), 0)], SPINE)
    for plan in ("window", "points"):
        hit = asof_join(spine, "ts", [side(features, created=None)], plan).first()["hit"]
        assert hit["value"] == {"b": 2}


def test_unknown_plan(spark):
    with pytest.raises(ValueError):
        asof_join(spark.range(1), "id", [], "other")


def test_planning_time_does_not_explode_with_the_number_of_features(spark):
    import time

    names = [f"f{i}" for i in range(60)]
    wide = spark.range(3).select(
        F.col("id").alias("key"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ets"),
        *[(F.col("id") + i).alias(n) for i, n in enumerate(names)],
    )
    spine = spark.createDataFrame([(1, hours(1), 0)], SPINE).filter("ts > timestamp_ntz'2023-01-01'")
    start = time.monotonic()
    df = asof_join(spine, "ts", [AsofSide("hit", wide, "ets", tuple(names), (("key", "key"),))], "window")
    row = df.select("key", *[F.col("hit").getField(n).alias(n) for n in names]).first()
    assert row["f59"] == 60 and time.monotonic() - start < 60


def test_hot_keys_of_different_periods_are_all_cut(spark):
    hour = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, {} / 1000.0)"
    brief = spark.range(20_000).selectExpr("0L AS k", hour.format("id * 180") + " AS ts")
    rest = spark.range(60_000).selectExpr("1 + id % 20 AS k", hour.format("id * 432000") + " AS ts")
    points = brief.unionAll(rest)
    limits = Limits(small_bytes=0, group_rows=500, sample_rows=200_000)
    skew = find_skew(points, ["k"], "ts", limits)
    assert len(skew.hot) == 21 and not skew.tied
    largest = with_slice(points, ["k"], "ts", skew, "slice").groupBy("k", "slice").count().agg(F.max("count")).first()[0]
    assert largest < 2 * limits.group_rows


def test_inputs_that_multiply_rows_are_not_small(spark, tmp_path):
    path = str(tmp_path / "few")
    spark.range(10).write.parquet(path)
    few = spark.read.parquet(path)
    limits = Limits(small_bytes=1 << 16)
    assert is_small(limits, few) and is_small(limits, few.join(few.withColumnRenamed("id", "n"), F.col("id") == F.col("n")))
    assert not is_small(limits, few.selectExpr("explode(sequence(0, 100000)) AS n"))
    assert not is_small(limits, few.join(few.withColumnRenamed("id", "n"), F.col("id") < F.col("n")))


def test_a_sample_drawn_too_large_is_thinned(spark):
    limits = Limits(sample_rows=100)
    sample, rows, fraction = draw_sample(spark.range(100_000), limits)
    assert rows <= 400 and abs(rows / fraction - 100_000) < 50_000
    sample.unpersist()
