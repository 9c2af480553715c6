"""Training sets made in parts, each from a stored carry and the rows after it."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import hours
from tidemark import Entity, Feature, FeatureStore, FeatureView, FileSource
from tidemark.errors import TidemarkError

SCHEMA = "k bigint, ts timestamp_ntz, created timestamp_ntz, x int"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Rows with ties in event and created time, null keys and times; spine rows between and on them."""
    draw = random.Random(3)
    rows = [
        (draw.choice([None, *range(8)]), draw.choice([None, *map(hours, range(40))]), hours(draw.randint(40, 42)), n)
        for n in range(600)
    ]
    folder = str(tmp_path_factory.mktemp("carry") / "features")
    spark.createDataFrame(rows, SCHEMA).write.parquet(folder)
    spine = [(draw.choice([None, *range(10)]), hours(draw.randint(0, 90) / 2), n) for n in range(300)]
    return folder, spark.createDataFrame(spine, "k bigint, ts timestamp_ntz, n int")


def make(spark, folder, ttl=None, keyless=False):
    source = FileSource(name="s", path=folder, event_timestamp_column="ts", created_timestamp_column="created")
    fs = FeatureStore(spark)
    fs.apply(Entity("e", "bigint", "k"), FeatureView("v", [] if keyless else ["e"], source, [Feature("x", "int")], ttl))
    return fs


def rows_of(*frames):
    return sorted((tuple(r) for f in frames for r in f.collect()), key=str)


@pytest.mark.parametrize("keyless", [False, True])
@pytest.mark.parametrize("ttl", [None, timedelta(hours=3)])
def test_parts_equal_the_whole(spark, stored, ttl, keyless):
    folder, spine = stored
    fs = make(spark, folder, ttl, keyless)
    cuts = [hours(10), hours(10.5), hours(25)]
    since = None
    for n, cut in enumerate(cuts):
        since = fs.save_carry(f"c{n}", cut, since=since)
    edges = [*zip([None, *cuts], [*cuts, None])]
    parts = []
    for n, (low, high) in enumerate(edges):
        part = spine if low is None else spine.filter(F.col("ts") >= F.lit(low))
        part = part if high is None else part.filter(F.col("ts") < F.lit(high))
        carry = fs.get_carry(f"c{n - 1}") if n else None
        parts.append(fs.get_historical_features(part, ["v:x"], carry=carry).df)
    assert rows_of(*parts) == rows_of(fs.get_historical_features(spine, ["v:x"]).df)


def test_the_source_is_read_from_the_cut_on(spark, stored, capsys):
    folder, spine = stored
    fs = make(spark, folder)
    carry = fs.save_carry("c", hours(20))
    late = spine.filter(F.col("ts") >= F.lit(hours(30)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    fs.get_historical_features(late, ["v:x"], carry=carry).df.explain()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    assert f"GreaterThan(ts,{hours(20).isoformat(timespec='minutes')}" in plan.replace(" ", "")
    assert carry.rows(spark, "v").groupBy("k").count().filter("count > 1").isEmpty()


def test_what_a_carry_cannot_serve(spark, stored):
    folder, spine = stored
    fs = make(spark, folder)
    carry = fs.save_carry("c", hours(20))
    with pytest.raises(TidemarkError, match="before the cut"):
        fs.get_historical_features(spine, ["v:x"], carry=carry)
    with pytest.raises(TidemarkError, match="already"):
        fs.save_carry("c", hours(21))
    with pytest.raises(TidemarkError, match="after"):
        fs.save_carry("d", hours(5), since=carry)
    with pytest.raises(TidemarkError, match="no carry"):
        fs.get_carry("other")
    empty = fs.save_carry("none", hours(20), views=[])
    with pytest.raises(TidemarkError, match="holds nothing"):
        fs.get_historical_features(spine.filter(F.col("ts") >= F.lit(hours(30))), ["v:x"], carry=empty)
