"""Registration, inference, references and naming."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.frames import hours
from tidemark import (
    Entity,
    Feature,
    FeatureService,
    FeatureStore,
    FeatureView,
    FrameSource,
    PushSource,
    RequestSource,
    RequestView,
    ValueType,
    on_demand_view,
)
from tidemark.errors import (
    DuplicateName,
    EntityNotFound,
    FeatureNameCollision,
    FeatureNotFound,
    InferenceError,
    MissingRequestData,
    MissingSpineColumns,
    ServiceNotFound,
    SourceValidationError,
    TypeMismatch,
    ViewNotFound,
)
from tidemark.functions.types import check_declared, fits, spark_type
from tidemark.plans.resolve import resolve
from tidemark.sources.inference import feature_columns, single_time_column
from tidemark.sources.spine import as_spine, infer_spine_time

DRIVER = Entity("driver", "bigint", "driver_id")


@pytest.fixture()
def frame(spark):
    rows = [(1, hours(0), hours(0), 0.5, 10), (2, hours(0), hours(0), None, 20)]
    schema = (
        "driver_id bigint, event_timestamp timestamp_ntz, created timestamp_ntz, "
        "conv_rate double, trips int"
    )
    return spark.createDataFrame(rows, schema)


def source(frame, **options):
    options.setdefault("event_timestamp_column", "event_timestamp")
    options.setdefault("created_timestamp_column", "created")
    return FrameSource(name=options.pop("name", "stats"), df=frame, **options)


@pytest.fixture()
def store(spark, frame):
    fs = FeatureStore(spark)
    fs.apply(DRIVER, FeatureView("stats", ["driver"], source(frame)))
    return fs


def test_features_are_inferred_from_the_source(store):
    assert [(f.name, f.dtype) for f in store.view("stats").features] == [
        ("conv_rate", T.DoubleType()),
        ("trips", T.IntegerType()),
    ]


def test_inference_leaves_out_underscored_names(spark):
    schema = T.StructType.fromDDL("k bigint, __index_level_0__ bigint, __x int, y__ int, z int")
    assert [f.name for f in feature_columns(schema, {"k"})] == ["z"]
    with pytest.raises(InferenceError):
        feature_columns(schema, {"k", "z"})


def test_entity_type_is_inferred(spark, frame):
    fs = FeatureStore(spark)
    fs.apply(Entity("driver", join_key="driver_id"), FeatureView("stats", ["driver"], source(frame)))
    assert fs.entity("driver").value_type == T.LongType()


def test_event_time_is_inferred_if_unique(spark, frame):
    fs = FeatureStore(spark)
    only = frame.drop("created")
    fs.apply(DRIVER, FeatureView("v", ["driver"], FrameSource(name="s", df=only)))
    assert fs.view("v").source.event_timestamp_column == "event_timestamp"
    with pytest.raises(InferenceError):
        single_time_column(frame.schema)
    with pytest.raises(InferenceError):
        single_time_column(frame.select("trips").schema)


def test_bad_sources_are_rejected(spark, frame):
    fs = FeatureStore(spark)
    fs.apply(DRIVER)
    with pytest.raises(SourceValidationError):
        fs.apply(FeatureView("v", ["driver"], source(frame.drop("driver_id"))))
    with pytest.raises(SourceValidationError):
        fs.apply(FeatureView("v", ["driver"], source(frame, field_mapping={"gone": "x"})))
    with pytest.raises(SourceValidationError):
        fs.apply(FeatureView("v", ["driver"], source(frame, event_timestamp_column="trips")))
    with pytest.raises(TypeMismatch):
        fs.apply(FeatureView("v", ["driver"], source(frame), [Feature("conv_rate", "string")]))
    with pytest.raises(EntityNotFound):
        fs.apply(FeatureView("v", ["rider"], source(frame)))


def test_names_that_differ_in_case_only(spark, frame, store):
    with pytest.raises(DuplicateName):
        store.apply(FeatureView("Stats", ["driver"], source(frame)))
    with pytest.raises(DuplicateName):
        store.apply(source(frame, name="a"), source(frame, name="A"))
    store.apply(FeatureView("stats", ["driver"], source(frame)))


def test_unknown_names(store):
    with pytest.raises(ViewNotFound):
        store.view("other")
    with pytest.raises(ServiceNotFound):
        store.service("other")
    with pytest.raises(ViewNotFound):
        resolve(["other:x"], {}, False)
    with pytest.raises(ViewNotFound):
        resolve(["no colon"], {}, False)
    with pytest.raises(FeatureNotFound):
        store.get_historical_features("SELECT 1", ["stats:gone"])
    with pytest.raises(FeatureNotFound):
        store.view("stats")[["gone"]]
    with pytest.raises(ViewNotFound):
        store.apply(FeatureService("s", [FeatureView("other", [], None, [Feature("x", "int")])]))


def test_colliding_names(spark, frame, store):
    store.apply(FeatureView("more", ["driver"], source(frame, name="more")))
    refs = ["stats:trips", "more:trips"]
    with pytest.raises(FeatureNameCollision):
        resolve(refs, {v.name: v for v in store.views()}, False)
    resolve(refs, {v.name: v for v in store.views()}, True)
    with pytest.raises(FeatureNameCollision):
        resolve(["stats:trips", "stats:trips"], {v.name: v for v in store.views()}, True)
    spine = frame.select("driver_id", "event_timestamp", "trips")
    with pytest.raises(FeatureNameCollision):
        store.get_historical_features(spine, ["stats:trips"])


def test_spine_checks(spark, frame, store):
    with pytest.raises(MissingSpineColumns):
        store.get_historical_features(frame.select("event_timestamp"), ["stats:trips"])
    assert infer_spine_time(frame.select("event_timestamp", "created")) == "event_timestamp"
    assert infer_spine_time(frame.select("created", "trips")) == "created"
    with pytest.raises(InferenceError):
        infer_spine_time(frame.select("trips"))


def test_spine_from_pandas_reads_naive_times_as_utc(spark):
    import pandas as pd

    rows = pd.DataFrame(
        {
            "naive": pd.to_datetime(["2024-01-01 12:00"]),
            "zoned": pd.to_datetime(["2024-01-01 12:00"]).tz_localize("US/Pacific"),
        }
    )
    seconds = as_spine(spark, rows).select(F.unix_seconds("naive"), F.unix_seconds("zoned")).first()
    assert seconds[1] - seconds[0] == 8 * 3600


def test_projection_alias_and_key_map(spark, frame, store):
    view = store.view("stats")
    service = FeatureService(
        "both",
        [
            view[["trips"]].with_name("first").with_join_key_map({"driver_id": "first_id"}),
            view[["trips"]].with_name("second").with_join_key_map({"driver_id": "second_id"}),
        ],
    )
    store.apply(service)
    spine = spark.createDataFrame(
        [(1, 2, hours(1))], "first_id bigint, second_id bigint, event_timestamp timestamp_ntz"
    )
    job = store.get_historical_features(spine, service, full_feature_names=True)
    row = job.df.first()
    assert (row["first__trips"], row["second__trips"]) == (10, 20)
    assert job.join_keys == ("first_id", "second_id")
    assert job.features == ("first:trips", "second:trips")


def test_request_view_and_on_demand(spark, frame, store):
    age = RequestView("driver_age", RequestSource("age", {"age": "int"}))
    extra = RequestSource("extra", {"val_to_add": "int"})

    @on_demand_view([store.view("stats"), extra])
    def plus(c):
        return {"total": c["stats__conv_rate"] + c["val_to_add"], "both": c["trips"] + c["stats__trips"]}

    store.apply(age, plus)
    assert [(f.name, f.dtype.simpleString()) for f in store.view("plus").features] == [
        ("total", "double"),
        ("both", "int"),
    ]
    spine = frame.select("driver_id", "event_timestamp")
    refs = ["plus:total", "driver_age:age"]
    with pytest.raises(MissingRequestData):
        store.get_historical_features(spine, refs)
    full = spine.withColumn("val_to_add", F.lit(100)).withColumn("age", F.lit(30))
    df = store.get_historical_features(full, refs, full_feature_names=True).df
    assert df.columns == [
        "driver_id", "event_timestamp", "val_to_add", "age", "plus__total", "driver_age__age",
    ]
    got = {r["driver_id"]: r["plus__total"] for r in df.collect()}
    assert got == {1: 100.5, 2: None}


def test_pandas_transform_sees_only_its_inputs(spark, frame, store):
    seen = []

    @on_demand_view([store.view("stats")[["trips"]]], mode="pandas")
    def doubled(rows):
        if len(rows) == 0:
            seen.append(sorted(rows.columns))
        rows["twice"] = rows["trips"] * 2
        return rows[["twice"]]

    store.apply(doubled)
    assert seen[0] == ["stats__trips", "trips"]
    spine = frame.select("driver_id", "event_timestamp", F.lit("x").alias("passed"))
    rows = store.get_historical_features(spine, ["doubled:twice"]).df.collect()
    assert {(r["driver_id"], r["twice"], r["passed"]) for r in rows} == {(1, 20, "x"), (2, 40, "x")}


def test_declared_outputs_must_exist(spark, frame, store):
    @on_demand_view([store.view("stats")], [Feature("gone", "double")])
    def bad(c):
        return {"here": c["trips"]}

    with pytest.raises(FeatureNotFound):
        store.apply(bad)


def test_unapplied_input_view(spark, frame):
    fs = FeatureStore(spark)
    view = FeatureView("nowhere", [], source(frame), [Feature("trips", "int")])

    @on_demand_view([view], [Feature("x", "int")])
    def uses(c):
        return {"x": c["trips"]}

    with pytest.raises(ViewNotFound):
        fs.apply(uses)


def test_removal(store):
    service = FeatureService("s", [store.view("stats")])
    store.apply(service)
    store.remove_service("s")
    store.remove_view("stats")
    assert store.views() == [] and store.services() == []


def test_value_types():
    assert len(ValueType) == 16
    assert spark_type("array<bigint>") == ValueType.INT64_LIST.value
    with pytest.raises(TypeMismatch):
        spark_type(T.NullType())
    assert fits(T.IntegerType(), T.LongType()) and not fits(T.LongType(), T.IntegerType())
    assert fits(T.ArrayType(T.FloatType()), T.ArrayType(T.DoubleType()))


def test_types_are_checked_from_the_schema_alone(spark):
    df = spark.range(1).selectExpr("id", "raise_error('no job may run') AS v")
    with pytest.raises(TypeMismatch):
        check_declared(df, {"id": T.StringType()}, "view")


def test_push_source_checks_its_schema(spark, frame):
    push = PushSource(name="p", schema={"driver_id": "bigint", "trips": "bigint"})
    assert push.check(frame).schema["trips"].dataType == T.LongType()
    with pytest.raises(SourceValidationError):
        push.check(frame.drop("trips"))
    with pytest.raises(TypeMismatch):
        PushSource(name="p", schema={"conv_rate": "string"}).check(frame)


def test_ttl_of_zero_means_no_limit(spark, frame):
    fs = FeatureStore(spark)
    fs.apply(DRIVER, FeatureView("v", ["driver"], source(frame), ttl=timedelta(0)))
    spine = spark.createDataFrame([(1, hours(9999))], "driver_id bigint, event_timestamp timestamp_ntz")
    assert fs.get_historical_features(spine, ["v:trips"]).df.first()["trips"] == 10
