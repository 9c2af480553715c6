"""Saved datasets, expectations, quantiles and the consistency of training and lookup."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import hours
from tidemark import (
    Entity,
    FeatureStore,
    FeatureView,
    FileSource,
    FileStorage,
    FrameSource,
    QuerySource,
    TableSource,
    TableStorage,
)
from tidemark.errors import SavedDatasetNotFound, SourceValidationError, ValidationFailed
from tidemark.functions.keys import entity_hash, entity_key, row_id
from tidemark.functions.times import align, epoch_seconds, in_zone
from tidemark.functions.types import cast_failures, spark_type
from tidemark.operators import quality as dq
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans.historical import time_span
from tidemark.plans.sizes import Limits
from tidemark.sources.batch import ConnectorSource, check_partition_format


@pytest.fixture()
def job(spark):
    frame = spark.createDataFrame(
        [(i, hours(i), float(i)) for i in range(10)],
        "id bigint, event_timestamp timestamp_ntz, balance double",
    )
    fs = FeatureStore(spark)
    source = FrameSource(name="s", df=frame, event_timestamp_column="event_timestamp")
    fs.apply(Entity("thing", "bigint", "id"), FeatureView("v", ["thing"], source))
    return fs, fs.get_historical_features(frame.select("id", "event_timestamp"), ["v:balance"])


def test_saved_dataset_keeps_rows_and_metadata(spark, job):
    fs, retrieval = job
    fs.create_saved_dataset(retrieval, "d", tags={"a": "b"})
    saved = fs.get_saved_dataset("d")
    assert saved.features == ("v:balance",) and saved.join_keys == ("id",)
    assert (saved.min_event_timestamp, saved.max_event_timestamp) == (hours(0), hours(9))
    assert saved.tags == {"a": "b"}
    want = sorted(map(tuple, retrieval.df.collect()))
    assert sorted(map(tuple, saved.to_spark_df(spark).collect())) == want
    with pytest.raises(SavedDatasetNotFound):
        fs.get_saved_dataset("other")


def test_same_name_replaces_even_when_derived_from_itself(spark, job):
    from dataclasses import replace

    fs, retrieval = job
    fs.create_saved_dataset(retrieval, "d")
    again = fs.get_saved_dataset("d").to_spark_df(spark).filter("id < 4")
    fs.create_saved_dataset(replace(retrieval, df=again), "d")
    saved = fs.get_saved_dataset("d")
    assert saved.to_spark_df(spark).count() == 4 and saved.max_event_timestamp == hours(3)


def test_storages(spark, job, tmp_path):
    _, retrieval = job
    for storage in (
        FileStorage(str(tmp_path / "p")),
        FileStorage(str(tmp_path / "j"), "json"),
        TableStorage("saved_rows", path=str(tmp_path / "t")),
    ):
        retrieval.persist(storage)
        assert storage.read(spark).count() == 10


def test_collecting(job):
    _, retrieval = job
    assert len(retrieval.to_df()) == 10
    assert retrieval.to_arrow().num_rows == 10
    assert sorted(r["id"] for r in retrieval.to_rows()) == list(range(10))


def test_validation_against_a_saved_dataset(spark, job):
    fs, retrieval = job
    saved = fs.create_saved_dataset(retrieval, "d")
    passing = fs.as_reference(saved, dq.auto_profile)
    assert len(retrieval.to_df(validation_reference=passing)) == 10
    assert fs.as_reference(saved).expectations == passing.expectations

    def unrealistic(df):
        return [
            dq.max_between("balance", -1000, -100),
            dq.values_in_set("balance", [0.0]),
            dq.min_between("balance", 0, 1000),
        ]

    with pytest.raises(ValidationFailed) as failed:
        retrieval.to_df(validation_reference=fs.as_reference(saved, unrealistic))
    assert [r["check_name"] for r in failed.value.report] == [dq.MAX_BETWEEN, dq.VALUES_IN_SET]
    assert [r["column_name"] for r in failed.value.report] == ["balance", "balance"]


def test_checks_treat_nulls_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (100.0,)], "x double")
    checks = [
        dq.values_between("x", 0, 10),
        dq.values_between("x", 0, 10, mostly=0.6),
        dq.values_not_null("x"),
        dq.values_not_null("x", 0.75),
        dq.mean_between("x", 34, 35),
        dq.quantiles_between("x", [0.0, 0.5, 1.0], [(1, 1), (3, 3), (None, 100)]),
    ]
    rows = dq.report(df, checks).orderBy("position").collect()
    assert [r["success"] for r in rows] == [False, True, False, True, True, True]
    assert {r["missing_count"] for r in rows} == {1} and rows[0]["missing_percent"] == 25.0
    assert rows[0]["unexpected_count"] == 1


def test_checks_on_no_values(spark):
    df = spark.createDataFrame([], "x double")
    checks = [dq.values_between("x", 0, 1), dq.min_between("x", 0, 1), dq.quantiles_between("x", [0.5], [(0, 1)])]
    assert [r["success"] for r in dq.report(df, checks).orderBy("position").collect()] == [True, False, False]
    assert dq.report(df, []).count() == 0


def test_all_checks_take_one_pass(spark, capsys, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(10).selectExpr("id", "id * 2 AS y").write.parquet(path)
    checks = [dq.values_between("id", 0, 5), dq.max_between("y", 0, 5), dq.values_not_null("id")]
    dq.report(spark.read.parquet(path), checks).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


@pytest.mark.parametrize("limits", [Limits(), Limits(small_bytes=0, group_rows=40, sample_rows=10_000)])
def test_exact_quantiles(spark, limits):
    values = [float((i * 7919) % 301) for i in range(1000)] + [5.0] * 400
    rows = [(v,) for v in values] + [(None,)] * 7
    df = spark.createDataFrame(rows, "x double").repartition(5)
    wanted = [0.0, 0.01, 0.25, 0.5, 0.333, 0.9, 1.0]
    found = exact_quantiles(df, "x", wanted, limits)
    got = found.first()["quantiles"]
    assert got == [float(np.quantile(values, p, method="nearest")) for p in wanted]


def test_auto_profile(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS few", "if(id = 5, null, 'x') AS gap")
    checks = {(e.check, e.column) for e in dq.auto_profile(df, ["few", "gap"])}
    assert (dq.VALUES_IN_SET, "few") in checks and (dq.VALUES_BETWEEN, "id") in checks
    assert (dq.VALUES_NOT_NULL, "gap") not in checks and (dq.VALUES_IN_SET, "gap") in checks
    shifted = df.withColumn("few", F.col("few") + 1)
    assert [r["column_name"] for r in dq.failures(shifted, dq.auto_profile(df, ["few"])).collect()] == ["few"]


def test_prepared_columns(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 01:02:03' AS t, float(0.5) AS f")
    row = dq.prepared(df).first()
    assert row["t"] == "2024-01-01T01:02:03"
    assert dq.prepared(df).schema["f"].dataType.simpleString() == "double"


def test_consistency_report_counts_differences(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "k int, v double, s string")
    a = a.unionAll(spark.createDataFrame([(3, 1.0, "z")], a.schema))
    report = dq.consistency_report(a, b, ["k"], ["v", "s"]).collect()
    rows = {r["feature"]: (r["compared"], r["different"], r["missing"]) for r in report}
    assert rows == {"v": (3, 1, 1), "s": (3, 0, 1)}


def test_source_kinds_and_pushdown(spark, tmp_path, capsys):
    frame = spark.createDataFrame([(i, hours(i)) for i in range(48)], "id bigint, ts timestamp_ntz")
    path = str(tmp_path / "by_day")
    frame.withColumn("day", F.col("ts").cast("date").cast("string")).write.partitionBy("day").parquet(path)
    source = FileSource(name="f", path=path, event_timestamp_column="ts", date_partition_column="day")
    df = source.load(spark, hours(30), hours(40))
    assert df.count() == 11
    df.explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts" in plan and "PartitionFilters: [isnotnull(day" in plan
    assert source.load(spark, hours(30), hours(40), closed="left").count() == 10
    frame.createOrReplaceTempView("things")
    assert TableSource(table="things").read(spark).count() == 48
    assert QuerySource(query="SELECT * FROM things WHERE id < 5").read(spark).count() == 5
    assert QuerySource(query=lambda s: s.table("things")).read(spark).count() == 48


def test_span_is_utc_for_both_time_types(spark):
    df = spark.createDataFrame([(hours(0),), (hours(7),)], "ts timestamp_ntz")
    assert time_span(df, "ts") == (hours(0), hours(7))
    zoned = df.select(align(F.col("ts"), df.schema["ts"].dataType, spark_type("timestamp")).alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "US/Pacific")
        assert time_span(zoned, "ts") == (hours(0), hours(7))
        assert time_span(df, "ts") == (hours(0), hours(7))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_seconds_never_decrease(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.sql(
            "SELECT timestamp_ntz'2024-03-31 00:00:00' + make_dt_interval(0, 0, cast(id AS int)) AS t FROM range(400)"
        )
        values = [r[0] for r in df.select(epoch_seconds(F.col("t"), df.schema["t"].dataType)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [b - a for a, b in zip(values, values[1:])] == [60.0] * 399


def test_zones(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-07-01 12:00:00' AS t")
    assert df.select(in_zone(F.col("t"), "US/Pacific")).first()[0].hour == 19


def test_keys(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("a|", "b"), ("a", "|b")], "x string, y string")
    assert df.select(row_id(F.col("x"), F.col("y")).alias("r")).distinct().count() == 4
    assert df.select(entity_key(df, ["x", "y"]).alias("k")).distinct().count() == 4
    assert df.select(entity_hash(["x", "y"]).alias("h")).distinct().count() == 4
    same = df.select(entity_key(df, ["x", "y"]) == entity_key(df, ["y", "x"]))
    assert all(r[0] for r in same.collect())


def test_cast_failures(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert cast_failures(df, {"a": spark_type("int")}).first()["a"] == 1


def test_arrow_batches_and_query_text(spark, job):
    _, retrieval = job
    batches = list(retrieval.to_batches())
    assert sum(b.num_rows for b in batches) == 10 and batches[0].schema.names == retrieval.df.columns
    assert "Physical Plan" in retrieval.query_text()


def test_quantile_checks_of_a_column_share_their_plan(spark):
    df = spark.range(1000).selectExpr("id", "id * 2 AS twice")
    checks = [
        dq.quantiles_between("id", [0.5], [(400, 600)]),
        dq.quantiles_between("id", [0.5, 0.9], [(400, 600), (None, 10)]),
        dq.quantiles_between("twice", [0.1], [(150, 250)]),
        dq.values_not_null("id"),
    ]
    rows = dq.report(df, checks).orderBy("position").collect()
    assert [(r["success"], r["unexpected_count"]) for r in rows] == [(True, 0), (False, 1), (True, 0), (True, 0)]


def test_times_are_checked_as_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS t")
        assert dq.prepared(df).first()["t"] == "2024-03-10T02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_connectors_and_endpoints(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    source = ConnectorSource(format="parquet", options={"path": str(tmp_path / "t")})
    assert source.read(spark).count() == 3
    given = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            given.update(options)
            return self

        def option(self, key, value):
            given[key] = value
            return self

        def load(self, path):
            return path

    class Session:
        read = Reader()

    endpoint = FileSource(path="s3a://b/t", s3_endpoint_override="http://host:9000", options={"mergeSchema": "true"})
    assert endpoint.read(Session()) == "s3a://b/t"
    assert given == {"mergeSchema": "true", "fs.s3a.endpoint": "http://host:9000"}


@pytest.mark.parametrize("pattern, kind", [("yyyyMMdd", "int"), ("dd-MM-yyyy", "string"), ("yyyy-MM-dd", "double"), ("yyyy-MM", "int")])
def test_partition_formats_must_sort(pattern, kind):
    dtype = spark_type(kind)
    if (pattern, kind) == ("yyyyMMdd", "int"):
        check_partition_format(dtype, pattern)
    else:
        with pytest.raises(SourceValidationError):
            check_partition_format(dtype, pattern)
