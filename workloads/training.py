"""Point-in-time joins and the sources that feed them."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import (
    Feature,
    FeatureService,
    FeatureView,
    FileSource,
    FileStorage,
    RequestSource,
    TableSource,
    TableStorage,
    on_demand_view,
)
from tidemark.functions.columns import q
from tidemark.functions.keys import entity_hash, entity_key, row_id
from tidemark.functions.times import align, from_seconds, in_zone, seconds_of
from tidemark.functions.types import ValueType, cast_declared, cast_failures, spark_type
from tidemark.functions.vectors import cosine_similarity
from tidemark.operators.grid import spine_grid
from tidemark.operators.latest import pull_all, pull_latest
from tidemark.plans.sizes import DEFAULT_LIMITS, Limits
from tidemark.session import shared_folder
from workloads import views as v

TTL = timedelta(hours=12)
MONTH = timedelta(days=30)
REFS = ["activity:value", "activity:event_type"]

# Bounds low enough that the benchmark tables take the path of very large inputs.
TINY_GROUPS = Limits(small_bytes=0, group_rows=50, sample_rows=20_000)


def pit_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.activity(sf_dir))
    return fs.get_historical_features(v.purchases(spark, sf_dir), REFS).df


def pit_ttl(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    fs = v.store(spark, v.activity(sf_dir, TTL))
    return fs.get_historical_features(v.purchases(spark, sf_dir), REFS, **options).df


def pit_full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.activity(sf_dir))
    return fs.get_historical_features(v.purchases(spark, sf_dir), REFS, True).df


def pit_distinct_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit_ttl(spark, sf_dir, plan="points")


def pit_spine_range_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit_ttl(spark, sf_dir, prune=True)


def pit_key_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of keys that no purchase has are left out by a Bloom filter of the spine's keys."""
    fs = v.store(spark, v.activity(sf_dir), limits=replace(DEFAULT_LIMITS, exact_keys=0))
    return fs.get_historical_features(v.purchases(spark, sf_dir), REFS, prune_keys=True).df


def pit_key_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys become literals of a filter: nations twice, under two names."""
    return pit_alias_twice(spark, sf_dir, prune_keys=True)


def pit_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts of the spine in time; the later two read only events after a stored carry."""
    fs = v.store(spark, v.activity(sf_dir))
    first, second = datetime(2024, 1, 10), datetime(2024, 1, 20)
    fs.save_carry("first", first)
    fs.save_carry("second", second, since=fs.get_carry("first"))
    purchases = v.purchases(spark, sf_dir)
    at = [F.lit(t).cast("timestamp_ntz") for t in (first, second)]
    parts = [
        (F.col("ts") < at[0], None),
        ((F.col("ts") >= at[0]) & (F.col("ts") < at[1]), fs.get_carry("first")),
        (F.col("ts") >= at[1], fs.get_carry("second")),
    ]
    found = [fs.get_historical_features(purchases.filter(p), REFS, carry=c).df for p, c in parts]
    return reduce(DataFrame.unionAll, found)


def pit_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time-sliced plan of hot keys, on suppliers with many ties per day."""
    fs = v.store(spark, v.supplier_lines(sf_dir), limits=TINY_GROUPS)
    refs = ["supplier_lines:l_quantity", "supplier_lines:l_extendedprice"]
    return fs.get_historical_features(v.lines(spark, sf_dir), refs, plan="sliced").df


def pit_created_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.supplier_lines(sf_dir))
    refs = ["supplier_lines:l_quantity", "supplier_lines:l_extendedprice"]
    return fs.get_historical_features(v.lines(spark, sf_dir), refs).df


def pit_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.customer_orders(sf_dir))
    orders = v.table(spark, sf_dir, "orders")
    spine = orders.select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("asked")
    )
    refs = ["customer_orders:o_totalprice", "customer_orders:o_orderstatus"]
    return fs.get_historical_features(spine, refs).df


def pit_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.supplier_flag_daily(sf_dir))
    refs = ["supplier_flag_daily:flag_quantity"]
    return fs.get_historical_features(v.lines(spark, sf_dir), refs).df


def pit_entityless(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.daily_totals(sf_dir, timedelta(days=2)))
    spine = v.table(spark, sf_dir, "events").select("event_id", "ts")
    refs = ["daily_totals:n_events", "daily_totals:total_value"]
    return fs.get_historical_features(spine, refs).df


def pit_entityless_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = Limits(small_bytes=0, group_rows=1000, sample_rows=20_000)
    fs = v.store(spark, v.daily_totals(sf_dir, timedelta(days=2)), limits=limits)
    spine = v.table(spark, sf_dir, "events").select("event_id", "ts")
    refs = ["daily_totals:n_events", "daily_totals:total_value"]
    return fs.get_historical_features(spine, refs).df


def pit_alias_twice(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    view = v.nation_daily(sf_dir, timedelta(days=7))
    buyers = view.with_name("buyer").with_join_key_map({"nation": "customer_nation"})
    sellers = view.with_name("seller").with_join_key_map({"nation": "supplier_nation"})
    service = FeatureService("nations", [buyers, sellers])
    fs = v.store(spark, view, service)
    return fs.get_historical_features(v.lines_with_nations(spark, sf_dir), service, True, **options).df


def pit_multi_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(
        spark,
        v.supplier_daily(sf_dir, MONTH),
        v.supplier_returns(sf_dir),
        v.customer_daily(sf_dir, timedelta(days=90)),
    )
    refs = [
        "supplier_daily:day_quantity",
        "supplier_daily:day_lines",
        "supplier_returns:returned_quantity",
        "customer_daily:day_spent",
        "customer_daily:day_orders",
    ]
    return fs.get_historical_features(v.lines_with_customer(spark, sf_dir), refs).df


def feature_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = v.supplier_daily(sf_dir, MONTH)
    customer = v.customer_daily(sf_dir, timedelta(days=90))
    service = FeatureService("model", [supplier[["day_lines"]], customer.with_name("buyer")])
    fs = v.store(spark, supplier, customer, service)
    spine = v.lines_with_customer(spark, sf_dir)
    return fs.get_historical_features(spine, fs.service("model"), True).df


# -- sources --------------------------------------------------------------------


def pit_field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = FileSource(
        name="mapped_events",
        path=f"{sf_dir}/events.parquet",
        event_timestamp_column="ts",
        field_mapping={"value": "amount", "event_type": "kind", "ts": "happened"},
    )
    view = FeatureView(
        "mapped", ["user"], source, [Feature("amount", "double"), Feature("kind", "string")]
    )
    fs = v.store(spark, view)
    refs = ["mapped:amount", "mapped:kind"]
    return fs.get_historical_features(v.purchases(spark, sf_dir), refs).df


def pit_sql_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.supplier_daily(sf_dir, MONTH))
    refs = ["supplier_daily:day_quantity", "supplier_daily:day_lines"]
    return fs.get_historical_features(v.lines(spark, sf_dir), refs).df


def pit_sql_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.activity(sf_dir))
    spine = (
        f"SELECT event_id, user_id, ts FROM parquet.`{sf_dir}/events.parquet` "
        "WHERE event_type = 'purchase'"
    )
    return fs.get_historical_features(spine, REFS).df


def _in_day_files(by_day: DataFrame) -> DataFrame:
    """Rows of a day, or of whatever the column ``day`` holds, together, in as many tasks as they need.

    Adaptive execution merges small days and splits large ones by the bytes of the shuffle, so a
    task never holds a whole month because it is written as one folder.
    """
    return by_day.hint("rebalance", "day")


def pit_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored by day; the spine's time span selects the days to read."""
    folder = shared_folder(spark, "events-by-day")
    events = v.table(spark, sf_dir, "events")
    by_day = _in_day_files(events.withColumn("day", F.col("ts").cast("date")))
    by_day.write.partitionBy("day").mode("overwrite").parquet(folder)
    source = FileSource(
        name="events_by_day",
        path=folder,
        event_timestamp_column="ts",
        date_partition_column="day",
    )
    features = [Feature("value", "double"), Feature("event_type", "string")]
    fs = v.store(spark, FeatureView("by_day", ["user"], source, features, TTL))
    late = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    spine = v.purchases(spark, sf_dir).filter(late)
    refs = ["by_day:value", "by_day:event_type"]
    return fs.get_historical_features(spine, refs, prune=True).df


DAY_FORMS = {
    "text": ("yyyyMMdd", "string"),
    "number": ("yyyyMMdd", "int"),
    "month": ("yyyy-MM", "string"),
    "date": ("yyyy-MM-dd", "date"),
    "unknown": (None, "string"),
}


def pit_partition_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written as text, numbers, months and dates; pruning on, off and automatic."""
    events = v.table(spark, sf_dir, "events")
    late = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    spine = v.purchases(spark, sf_dir).filter(late)
    features = [Feature("value", "double"), Feature("event_type", "string")]
    out = []
    for form, (pattern, kind) in DAY_FORMS.items():
        folder = shared_folder(spark, f"events-by-{form}")
        written = F.date_format("ts", pattern or "dd/MM/yyyy").cast(kind)
        by_day = events.withColumn("day", F.translate(written.cast("string"), "/", "_") if pattern is None else written)
        _in_day_files(by_day).write.partitionBy("day").parquet(folder)
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in events.schema)}, day {kind}"
        source = FileSource(
            name=form,
            path=folder,
            file_schema=schema,
            event_timestamp_column="ts",
            date_partition_column="day",
            date_partition_format=pattern,
        )
        fs = v.store(spark, FeatureView("by_day", ["user"], source, features, TTL))
        for prune in (True, False, "auto"):
            found = fs.get_historical_features(spine, ["by_day:value", "by_day:event_type"], prune=prune).df
            out.append(found.withColumn("form", F.lit(form)).withColumn("prune", F.lit(str(prune))))
        fs.materialize(datetime(2024, 1, 1), datetime(2024, 1, 15), now=v.NOW)
        stored = fs.snapshots.read("by_day", ["user_id"])
        loaded = stored.select(
            F.lit(None).cast("bigint").alias("event_id"),
            "user_id",
            F.lit(None).cast("timestamp_ntz").alias("ts"),
            "value",
            "event_type",
            F.lit(form).alias("form"),
            F.lit("loaded").alias("prune"),
        )
        out.append(loaded)
    return reduce(DataFrame.unionByName, out)


def source_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through every file format and a catalog table."""
    orders = v.table(spark, sf_dir, "orders")
    folder = shared_folder(spark, "formats")
    sources = {}
    for name in ("csv", "json", "parquet"):
        FileStorage(f"{folder}/{name}", name).write(orders)
        sources[name] = FileSource(
            name=name,
            path=f"{folder}/{name}",
            file_format=name,
            file_schema=orders.schema,
            event_timestamp_column="o_orderdate",
        )
    table = "orders_" + folder.rstrip("/").rsplit("-", 1)[-1].replace(".", "_")
    TableStorage(table, path=f"{folder}/table").write(orders)
    sources["table"] = TableSource(name="table", table=table, event_timestamp_column="o_orderdate")

    out = None
    for name, source in sources.items():
        total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
        row = source.load(spark).agg(
            F.lit(name).alias("format"),
            F.count(F.lit(1)).alias("n"),
            total.alias("total"),
            F.min("o_orderdate").alias("first_date"),
            F.max("o_orderdate").alias("last_date"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def timestamps_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-less wall-clock times of three zones brought to UTC."""
    events = v.table(spark, sf_dir, "events")
    dtype = events.schema["ts"].dataType
    zoned = align(F.col("ts"), dtype, spark_type(ValueType.UNIX_TIMESTAMP))
    return events.select(
        "event_id",
        in_zone(F.col("ts"), "Europe/Berlin").alias("from_berlin"),
        in_zone(F.col("ts"), "US/Pacific").alias("from_pacific"),
        align(zoned, spark_type(ValueType.UNIX_TIMESTAMP), dtype).alias("through_utc"),
        seconds_of(zoned).alias("whole_seconds"),
        align(from_seconds(seconds_of(zoned)), spark_type("timestamp"), dtype).alias("cut"),
    )


# -- ranges ---------------------------------------------------------------------

START, END = datetime(2024, 1, 10), datetime(2024, 1, 20)


def latest_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = v.events_with_created(spark, sf_dir)
    return pull_latest(
        events, ["user_id"], ["value", "event_type"], "ts", "created", START, END
    )


def latest_entityless(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = v.events_with_created(spark, sf_dir)
    return pull_latest(events, [], ["value", "event_type"], "ts", "created", START, END)


def range_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = v.table(spark, sf_dir, "events")
    return pull_all(events, ["user_id", "value", "ts"], "ts", START, END)


def grid_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier active in 1997, at the start of every week of that year."""
    return spine_grid(
        v.table(spark, sf_dir, "lineitem"),
        ["l_suppkey"],
        "l_shipdate",
        datetime(1997, 1, 1),
        datetime(1997, 12, 31),
        timedelta(days=7),
    )


# -- transforms -----------------------------------------------------------------


def _rate_view(activity: FeatureView, mode: str):
    features = [Feature("per_hour", "double"), Feature("whole", "int")]
    if mode == "columns":

        @on_demand_view([activity], features, name="rates")
        def rates(c):
            return {
                "per_hour": F.round(c["activity__value"] / 24, 6),
                "whole": F.floor(c["value"] + 100),
            }

        return rates

    @on_demand_view([activity], features, mode="pandas", name="rates")
    def rates_pandas(rows):
        rows["per_hour"] = (rows["activity__value"] / 24).round(6)
        rows["whole"] = (rows["value"] + 100).floordiv(1).astype("Int32")
        return rows

    return rates_pandas


def _rates(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    activity = v.activity(sf_dir)
    fs = v.store(spark, activity, _rate_view(activity, mode))
    refs = ["rates:per_hour", "rates:whole", "activity:value"]
    return fs.get_historical_features(v.purchases(spark, sf_dir), refs).df


def odfv_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir, "columns")


def odfv_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir, "pandas")


def odfv_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and request columns together; inputs are fetched but not returned."""
    activity = v.activity(sf_dir)
    request = RequestSource("extra", {"to_add": "int"})

    @on_demand_view([activity, request], [Feature("value_plus", "double")])
    def added(c):
        return {"value_plus": F.round(c["value"] + c["to_add"], 2)}

    fs = v.store(spark, activity, added)
    spine = v.purchases(spark, sf_dir).withColumn("to_add", (F.col("event_id") % 10).cast("int"))
    return fs.get_historical_features(spine, ["added:value_plus"], True).df


def odfv_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each stored vector to the request's vector, its successor."""
    day = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")

    def read(session: SparkSession) -> DataFrame:
        return v.table(session, sf_dir, "embeddings").withColumn("ts", day)

    source = v.QuerySource(name="vectors", query=read, event_timestamp_column="ts")
    vectors = FeatureView("vectors", ["vector"], source, [Feature("embedding", "array<float>")])
    request = RequestSource("probe", {"probe": "array<float>"})

    @on_demand_view([vectors, request], [Feature("cosine", "double")])
    def similarity(c):
        return {"cosine": F.round(cosine_similarity(c["embedding"], c["probe"]), 5)}

    fs = v.store(spark, vectors, similarity)
    embeddings = v.table(spark, sf_dir, "embeddings")
    probes = embeddings.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("probe"), day.alias("asked")
    )
    joined = fs.get_historical_features(probes, ["similarity:cosine"]).df
    return joined.drop("probe", "asked")


# -- keys and types ---------------------------------------------------------------


def entity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = v.table(spark, sf_dir, "lineitem")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        entity_key(lineitem, ["l_suppkey", "l_returnflag"]).alias("key"),
        row_id(q("l_suppkey"), q("l_returnflag"), q("l_linestatus")).alias("id"),
    )


def entity_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key how many hashes it has, and over all keys how many hashes differ."""
    lineitem = v.table(spark, sf_dir, "lineitem")
    keys = ["l_suppkey", "l_returnflag"]
    hashed = lineitem.select(*keys, entity_hash(keys).alias("a"), entity_hash(keys[::-1]).alias("b"))
    per_key = hashed.groupBy(*keys).agg(
        F.count_distinct("a").alias("hashes"), F.min("a").alias("hash"), F.bool_and(F.col("a") == F.col("b")).alias("same")
    )
    return per_key.groupBy("hashes", "same").agg(
        F.count(F.lit(1)).alias("keys"), F.count_distinct("hash").alias("distinct_hashes")
    )


def type_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = {
        "c_custkey": spark_type(ValueType.STRING),
        "c_nationkey": spark_type(ValueType.INT64),
        "c_acctbal": spark_type(ValueType.INT32),
        "c_mktsegment": spark_type(ValueType.STRING),
        "c_name": spark_type(ValueType.DOUBLE),
    }
    return cast_declared(v.table(spark, sf_dir, "customer"), declared)


def cast_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = {
        "c_custkey": spark_type(ValueType.STRING),
        "c_name": spark_type(ValueType.DOUBLE),
        "c_mktsegment": spark_type(ValueType.INT32),
    }
    return cast_failures(v.table(spark, sf_dir, "customer"), declared)


def list_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole vectors cast to a declared list type; empty and null lists stay what they are."""
    embeddings = v.table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda x: F.floor(x * 1000).cast("double"))
    shaped = embeddings.select(
        "vec_id",
        scaled.alias("v"),
        F.when(F.col("label") >= 0, F.expr("cast(array() as array<double>)")).alias("none"),
        F.lit(None).cast("array<double>").alias("missing"),
    )
    declared = spark_type(ValueType.INT64_LIST)
    cast = cast_declared(shaped, {"v": declared, "none": declared, "missing": declared})
    return cast.select(
        "vec_id",
        F.size("v").alias("n"),
        F.get("v", F.lit(0)).alias("first"),
        F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        F.size("none").alias("n_none"),
        F.col("missing").isNull().alias("missing"),
    )
