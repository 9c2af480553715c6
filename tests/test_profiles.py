"""Profiles of parts, merged, and the bounds of value sets."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.operators.profiles import PartProfiles

SCHEMA = "day date, n bigint, x double, d decimal(20,2), name string, at timestamp_ntz, tags array<string>, m map<string,int>"


def rows(days, per_day=300, seed=1):
    draw = random.Random(seed)
    out = []
    for k in days:
        for _ in range(per_day):
            out.append(
                (
                    date(2024, 1, k), draw.choice([None, draw.randrange(2000)]), draw.gauss(0, 1), Decimal(draw.randrange(100)) / 4,
                    draw.choice("abc"), datetime(2024, 1, k, draw.randrange(24)), ["t"], {"a": 1},
                )
            )
    return out


def by_column(df):
    return {r["column_name"]: r for r in df.collect()}


def test_merged_profile_equals_the_whole_within_its_error(spark, tmp_path):
    data = rows(range(1, 11))
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    profiles = PartProfiles(spark, str(tmp_path / "p"))
    profiles.update(df.filter("day < '2024-01-06'"), F.col("day"))
    profiles.update(df, F.col("day"))
    assert profiles.parts() == [date(2024, 1, k) for k in range(1, 11)]
    found = by_column(profiles.profile(probabilities=[0.0, 0.5, 1.0]))
    numbers = [r[1] for r in data if r[1] is not None]
    assert found["n"]["row_count"] == len(data) and found["n"]["null_count"] == len(data) - len(numbers)
    assert abs(found["n"]["distinct_estimate"] - len(set(numbers))) <= 0.05 * len(set(numbers))
    assert (found["n"]["min_text"], found["n"]["max_text"]) == (str(min(numbers)), str(max(numbers)))
    xs = sorted(r[2] for r in data)
    low, middle, high = found["x"]["quantiles"]
    assert (low, high) == (xs[0], xs[-1])
    assert abs(sum(x <= middle for x in xs) / len(xs) - 0.5) <= 0.03
    assert found["x"]["mean_value"] == pytest.approx(sum(xs) / len(xs))
    assert found["name"]["distinct_estimate"] == 3 and found["name"]["quantiles"] is None
    assert found["at"]["max_text"].startswith("2024-01-10") and found["m"]["min_text"] is None
    assert found["tags"]["distinct_estimate"] is None
    some = by_column(profiles.profile(F.col("part") == date(2024, 1, 3)))
    assert some["n"]["row_count"] == 300


def test_only_new_parts_are_read_and_a_part_counts_once(spark, tmp_path):
    profiles = PartProfiles(spark, str(tmp_path / "p"))
    first = spark.createDataFrame(rows([1, 2]), SCHEMA)
    profiles.update(first, F.col("day"))
    changed = spark.createDataFrame(rows([1, 2, 3], per_day=10, seed=2), SCHEMA)
    profiles.update(changed, F.col("day"))
    assert by_column(profiles.profile())["n"]["row_count"] == 610
    profiles.update(changed, F.col("day"), again=[date(2024, 1, 2)])
    assert by_column(profiles.profile())["n"]["row_count"] == 320
    with pytest.raises(ValueError, match="other columns"):
        profiles.update(changed.drop("x"), F.col("day"))


def test_empty_and_unknown(spark, tmp_path):
    profiles = PartProfiles(spark, str(tmp_path / "p"))
    with pytest.raises(ValueError, match="nothing was profiled"):
        profiles.profile()
    profiles.update(spark.createDataFrame([(None, *r[1:]) for r in rows([1], 5)], SCHEMA), F.col("day"))
    assert profiles.parts() == []
    found = by_column(profiles.profile())
    assert found["n"]["row_count"] is None and found["x"]["quantiles"] is None


def test_extremes_keep_their_type(spark):
    df = spark.createDataFrame([(9007199254740993, "a", datetime(2024, 1, 1, 5)), (1, "b", datetime(2023, 1, 1))], "n bigint, s string, at timestamp_ntz")
    found = by_column(dq.column_profile(df))
    assert found["n"]["max_text"] == "9007199254740993" and found["s"]["min_text"] == "a"
    assert found["at"]["max_text"] == "2024-01-01 05:00:00"


def test_value_sets_are_bounded(spark):
    df = spark.range(3000).select((F.col("id") % 5).cast("string").alias("few"), F.col("id").alias("many"), (F.col("id") % 2 == 0).alias("flag"))
    assert sorted(dq.value_set(df, "few")) == ["0", "1", "2", "3", "4"]
    with pytest.raises(ValueError, match="more than"):
        dq.value_set(df, "many")
    assert dq.few_valued(df) == ["few", "flag"]
    sets = {e.column for e in dq.auto_profile(df, "few") if e.check.endswith("in_set")}
    assert sets == {"few", "flag"}
