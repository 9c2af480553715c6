"""A whole project: keyed, composite, aliased and key-less views, transforms, all types."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import hours
from tidemark import (
    Entity,
    Feature,
    FeatureService,
    FeatureStore,
    FeatureView,
    FrameSource,
    RequestSource,
    RequestView,
    on_demand_view,
)
from tidemark.operators.latest import EVENT_TS
from tidemark.plans.sizes import Limits

DRIVERS, CUSTOMERS, LOCATIONS = range(5001, 5009), range(1001, 1011), range(1, 13)
TWO_DAYS = timedelta(days=2)


def rows_of(rnd, keys, columns, step):
    """One row per key and step over three days, some twice with different created times."""
    out = []
    for key in keys:
        for h in range(0, 72, step):
            for _ in range(rnd.choice([1, 1, 1, 2])):
                values = [round(rnd.random() * 100, 3) if c == "double" else rnd.randrange(1000) for c in columns]
                out.append((*key, hours(h), hours(100 + rnd.randrange(50)), *values))
    return out


def as_of(rows, n_keys, key, ts, ttl):
    """Winning values for one spine row by a plain scan."""
    hits = [
        r for r in rows
        if r[:n_keys] == key and r[n_keys] <= ts and (ttl is None or r[n_keys] >= ts - ttl)
    ]
    if not hits:
        return None
    return max(hits, key=lambda r: (r[n_keys], r[n_keys + 1], r[n_keys + 2 :]))[n_keys + 2 :]


@pytest.fixture(scope="module")
def project(spark):
    rnd = random.Random(7)
    tables = {
        "driver_stats": (rows_of(rnd, [(d,) for d in DRIVERS], ["double", "int"], 1), 1, timedelta(hours=2)),
        "customer_profile": (rows_of(rnd, [(c,) for c in CUSTOMERS], ["double"], 24), 1, TWO_DAYS),
        "order": (rows_of(rnd, [(d, c) for d in DRIVERS for c in CUSTOMERS], ["int"], 30), 2, TWO_DAYS),
        "location_stats": (rows_of(rnd, [(x,) for x in LOCATIONS], ["int"], 5), 1, TWO_DAYS),
        "global_stats": (rows_of(rnd, [()], ["int"], 24), 0, TWO_DAYS),
        "field_mapping": (rows_of(rnd, [()], ["int"], 10), 0, None),
    }
    times = "ts timestamp_ntz, created timestamp_ntz"
    schemas = {
        "driver_stats": f"driver_id bigint, {times}, conv_rate double, trips int",
        "customer_profile": f"customer_id bigint, {times}, balance double",
        "order": f"driver_id bigint, customer_id bigint, {times}, success int",
        "location_stats": f"location_id bigint, {times}, temperature int",
        "global_stats": f"{times}, rides int",
        "field_mapping": f"{times}, column_name int",
    }
    entities = {
        "driver_stats": ["driver"],
        "customer_profile": ["customer"],
        "order": ["driver", "customer"],
        "location_stats": ["location"],
        "global_stats": [],
        "field_mapping": [],
    }
    views = {}
    for name, (rows, _, ttl) in tables.items():
        source = FrameSource(
            name=name,
            df=spark.createDataFrame(rows, schemas[name]),
            event_timestamp_column="ts",
            created_timestamp_column="created",
            field_mapping={"column_name": "feature_name"} if name == "field_mapping" else {},
        )
        views[name] = FeatureView(name, entities[name], source, ttl=ttl)

    fs = FeatureStore(spark)
    fs.apply(
        Entity("driver", join_key="driver_id"),
        Entity("customer", join_key="customer_id"),
        Entity("location", join_key="location_id"),
        *views.values(),
        RequestView("driver_age", RequestSource("age", {"age": "int"})),
    )
    extra = RequestSource("extra", {"val_to_add": "int"})
    outputs = [Feature("plus_100", "double"), Feature("plus_val", "double"), Feature("plus_100_rounded", "int")]

    @on_demand_view([fs.view("driver_stats"), extra], outputs)
    def conv_rate_plus_100(c):
        plus = c["conv_rate"] + 100
        return {
            "plus_100": plus,
            "plus_val": c["driver_stats__conv_rate"] + c["val_to_add"],
            "plus_100_rounded": F.bround(plus),
        }

    @on_demand_view([fs.view("driver_stats"), extra], outputs, mode="pandas")
    def conv_rate_pandas(rows):
        rows["plus_100"] = rows["conv_rate"] + 100
        rows["plus_val"] = rows["driver_stats__conv_rate"] + rows["val_to_add"]
        rows["plus_100_rounded"] = rows["plus_100"].round().astype("Int32")
        return rows

    fs.apply(conv_rate_plus_100, conv_rate_pandas)
    place = fs.view("location_stats")
    fs.apply(
        FeatureService(
            "everything",
            [
                *[fs.view(n) for n in ("driver_stats", "customer_profile", "order", "global_stats", "field_mapping")],
                place.with_name("origin").with_join_key_map({"location_id": "origin_id"}),
                place.with_name("destination").with_join_key_map({"location_id": "destination_id"}),
                fs.view("conv_rate_plus_100"),
                fs.view("driver_age"),
            ],
        )
    )
    spine = [
        (
            i,
            rnd.choice([*DRIVERS, 9999]),
            rnd.choice(CUSTOMERS),
            rnd.choice(LOCATIONS),
            rnd.choice(LOCATIONS),
            hours(rnd.random() * 90),
            30 + i % 3,
            i % 10,
        )
        for i in range(60)
    ]
    return fs, tables, spine


SPINE = (
    "order_id bigint, driver_id bigint, customer_id bigint, origin_id bigint, destination_id bigint, "
    "event_timestamp timestamp_ntz, age int, val_to_add int"
)


def expected(tables, spine):
    out = []
    for row in spine:
        _, driver, customer, origin, destination, ts, age, add = row

        def look(name, *key):
            rows, n, ttl = tables[name]
            return as_of(rows, n, key, ts, ttl) or (None,) * (len(rows[0]) - n - 2)

        rate, trips = look("driver_stats", driver)
        plus = None if rate is None else rate + 100
        out.append(
            (
                *row, rate, trips,
                *look("customer_profile", customer),
                *look("order", driver, customer),
                *look("global_stats"),
                *look("field_mapping"),
                *look("location_stats", origin),
                *look("location_stats", destination),
                plus,
                None if rate is None else rate + add,
                None if plus is None else round(plus),
                age,
            )
        )
    return Counter(out)


@pytest.mark.parametrize("limits", [Limits(), Limits(small_bytes=0, group_rows=100, sample_rows=50_000)])
def test_training_set_of_all_views(spark, project, limits):
    fs, tables, spine = project
    fs.limits = limits
    frame = spark.createDataFrame(spine, SPINE)
    df = fs.get_historical_features(frame, fs.service("everything"), full_feature_names=True).df
    assert df.columns[8:] == [
        "driver_stats__conv_rate", "driver_stats__trips", "customer_profile__balance", "order__success",
        "global_stats__rides", "field_mapping__feature_name", "origin__temperature",
        "destination__temperature", "conv_rate_plus_100__plus_100", "conv_rate_plus_100__plus_val",
        "conv_rate_plus_100__plus_100_rounded", "driver_age__age",
    ]
    assert Counter(map(tuple, df.collect())) == expected(tables, spine)


def test_both_kinds_of_transform_agree(spark, project):
    fs, _, spine = project
    frame = spark.createDataFrame(spine, SPINE)
    names = ["plus_100", "plus_val", "plus_100_rounded"]
    columns, pandas = (
        fs.get_historical_features(frame, [f"{view}:{n}" for n in names]).df.collect()
        for view in ("conv_rate_plus_100", "conv_rate_pandas")
    )
    assert Counter(map(tuple, columns)) == Counter(map(tuple, pandas))


def test_lookup_equals_training_at_the_same_moment(spark, project):
    fs, tables, spine = project
    at = hours(71.5)
    fs.materialize(hours(0), at, now=at)
    requests = spark.createDataFrame(spine, SPINE).drop("event_timestamp", "age")
    service = FeatureService(
        "keyed", [fs.view(n) for n in ("driver_stats", "customer_profile", "order", "global_stats", "field_mapping")]
    )
    asked = requests.withColumn("event_timestamp", F.lit(str(at)).cast("timestamp_ntz"))
    training = fs.get_historical_features(asked, service).df.drop("event_timestamp")
    found = fs.get_online_features(service, requests, now=at, metadata=False)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, training.collect()))


SCALARS = {
    "int": ("int", [1, 2]),
    "bigint": ("bigint", [1, 2]),
    "float": ("float", [0.5, 0.25]),
    "double": ("double", [0.1, 0.2]),
    "string": ("string", ["a", "b"]),
    "boolean": ("boolean", [True, False]),
    "binary": ("binary", [b"a", b"b"]),
    "timestamp": ("timestamp", [datetime(2024, 1, 1), datetime(2024, 1, 2)]),
}


@pytest.mark.parametrize("key_type", ["int", "bigint", "string"])
def test_every_type_offline_and_online(spark, key_type):
    """Scalars, lists, empty lists and nulls of every type come through unchanged."""
    rows, fields = [], []
    for n, (ddl, (a, b)) in enumerate(SCALARS.values()):
        fields += [f"s{n} {ddl}", f"l{n} array<{ddl}>", f"e{n} array<{ddl}>"]
    first, second = [], []
    for _, (a, b) in SCALARS.values():
        first += [a, [a, b], []]
        second += [None, None, [b]]
    rows = [(1, hours(0), *second), (1, hours(1), *first), (2, hours(1), *second)]
    frame = spark.createDataFrame(rows, f"k int, ts timestamp_ntz, {', '.join(fields)}")
    frame = frame.withColumn("k", F.col("k").cast(key_type))
    fs = FeatureStore(spark)
    source = FrameSource(name="t", df=frame, event_timestamp_column="ts")
    fs.apply(Entity("thing", join_key="k"), FeatureView("types", ["thing"], source, ttl=timedelta(days=5)))
    refs = [f"types:{f.name}" for f in fs.view("types").features]
    assert len(refs) == 24 and fs.entity("thing").value_type.simpleString() == key_type

    spine = frame.filter("ts > timestamp_ntz'2024-01-01'").select("k", F.col("ts").alias("event_timestamp"))
    offline = fs.get_historical_features(spine, refs).df.drop("event_timestamp")
    fs.materialize(hours(0), hours(1))
    online = fs.get_online_features(refs, spine.select("k"), metadata=False)
    want = frame.filter("ts > timestamp_ntz'2024-01-01'").drop("ts")
    for got in (offline, online):
        assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert fs.snapshots.read("types", ["k"]).schema[EVENT_TS].dataType.simpleString() == "timestamp_ntz"
