"""Leaving out feature rows of keys that no spine row has."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.frames import hours
from tidemark.operators.asof import AsofSide, asof_join
from tidemark.plans.keys import KeyFilter, key_filter
from tidemark.plans.sizes import DEFAULT_LIMITS

BLOOM = replace(DEFAULT_LIMITS, exact_keys=0)


def side(df, keys=(("k", "k"),), name="hit"):
    return AsofSide(name=name, df=df, ts="ts", values=("x",), keys=keys)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


VALUES = {
    "bigint": [1, 2, None, -5],
    "string": ["a", "é", "", None],
    "double": [0.0, -0.0, float("nan"), 1.5, None],
    "decimal(9,2)": [Decimal("1.10"), Decimal("-2.00")],
    "date": [datetime(2024, 1, 1).date(), datetime(1969, 5, 5).date()],
    "timestamp_ntz": [datetime(2024, 1, 1, 5), datetime(1960, 1, 1)],
    "boolean": [True, False],
    "binary": [b"", b"a"],
    "array<int>": [[1], [2]],
}


@pytest.mark.parametrize("dtype", sorted(VALUES))
@pytest.mark.parametrize("limits", [DEFAULT_LIMITS, BLOOM])
def test_every_type_of_key_gives_the_same_rows(spark, dtype, limits):
    values = VALUES[dtype]
    features = spark.createDataFrame([(v, hours(i), i) for i, v in enumerate(values * 3)], f"k {dtype}, ts timestamp_ntz, x int")
    spine = spark.createDataFrame([(v, hours(99)) for v in values[:2]], f"k {dtype}, ts timestamp_ntz")
    plain = rows_of(asof_join(spine, "ts", [side(features)], prune_keys=False))
    assert rows_of(asof_join(spine, "ts", [side(features)], limits=limits, prune_keys=True)) == plain
    assert any(r[-1] is not None for r in plain)


@pytest.mark.parametrize("limits", [DEFAULT_LIMITS, BLOOM])
@pytest.mark.parametrize("plan", ["window", "sliced", "points"])
def test_keys_of_several_columns_and_other_types(spark, plan, limits):
    features = spark.range(3000).select(
        (F.col("id") % 50).cast("int").alias("a"),
        (F.col("id") % 7).cast("string").alias("b"),
        (F.lit(hours(0)) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("ts"),
        F.col("id").alias("x"),
    )
    spine = spark.createDataFrame([(3, "3", hours(2)), (4, "0", hours(1)), (None, "1", hours(2)), (999, "1", hours(2))], "p long, q string, ts timestamp_ntz")
    sides = [side(features, (("p", "a"), ("q", "b"))), side(features, (("p", "a"),), "other")]
    plain = rows_of(asof_join(spine, "ts", sides, plan, prune_keys=False))
    assert rows_of(asof_join(spine, "ts", sides, plan, limits, prune_keys=True)) == plain


def test_few_keys_reach_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "features")
    spark.range(20_000).select(F.col("id").alias("k"), F.lit(hours(0)).alias("ts"), F.col("id").alias("x")).write.parquet(path)
    spine = spark.createDataFrame([(k, hours(1)) for k in range(0, 20_000, 4000)], "k bigint, ts timestamp_ntz")
    df = asof_join(spine, "ts", [side(spark.read.parquet(path))], prune_keys=True)
    assert "In(k, [" in plan_of(df, capsys)
    assert df.filter("hit.x = k").count() == 5
    off = asof_join(spine, "ts", [side(spark.read.parquet(path))])
    assert "In(k, [" not in plan_of(off, capsys)  # small tables are left alone


def test_bloom_filter_lies_below_the_exchange_and_cuts_the_rows(spark, tmp_path, capsys):
    path = str(tmp_path / "features")
    spark.range(200_000).select(F.col("id").alias("k"), F.lit(hours(0)).alias("ts"), F.col("id").alias("x")).write.parquet(path)
    features = spark.read.parquet(path)
    spine = spark.range(0, 200_000, 100).select(F.col("id").alias("k"), F.lit(hours(1)).alias("ts"))
    df = asof_join(spine, "ts", [side(features)], limits=BLOOM, prune_keys=True)
    assert df.filter("hit.x = k").count() == 2000
    plan = plan_of(df, capsys)
    window, semi = plan.index("Window"), plan.index("LeftSemi")
    assert "Exchange hashpartitioning(__ft_k0" in plan[window:semi]
    wanted = key_filter(spine.select("k"), ["k"], BLOOM)
    kept = wanted.keep(features)
    # one key in a hundred is asked for; false hits add less than that again
    assert 2000 <= kept.count() <= 4000
    assert wanted.words * 64 >= 16 * 1800 and wanted.rows.count() <= wanted.words


def test_too_many_keys_are_not_filtered(spark):
    spine = spark.range(5000).select(F.col("id").alias("k"))
    assert key_filter(spine, ["k"], replace(BLOOM, filter_words=16)) is None
    few = key_filter(spine, ["k"], replace(DEFAULT_LIMITS, exact_keys=10_000))
    assert isinstance(few, KeyFilter) and len(few.exact) == 5000


def test_no_spine_rows(spark):
    spine = spark.createDataFrame([], "k bigint, ts timestamp_ntz")
    features = spark.createDataFrame([(1, hours(0), 1)], "k bigint, ts timestamp_ntz, x int")
    for limits in (DEFAULT_LIMITS, BLOOM):
        assert asof_join(spine, "ts", [side(features)], limits=limits, prune_keys=True).count() == 0
