"""Entities, sources and views over the benchmark tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import (
    Entity,
    Feature,
    FeatureStore,
    FeatureView,
    FileSource,
    QuerySource,
)
from tidemark.plans.sizes import DEFAULT_LIMITS, Limits

USER = Entity("user", "bigint", "user_id")
SUPPLIER = Entity("supplier", "bigint", "l_suppkey")
CUSTOMER = Entity("customer", "bigint", "o_custkey")
FLAG = Entity("return_flag", "string", "l_returnflag")
NATION = Entity("nation", "int", "nation")
VECTOR = Entity("vector", "bigint", "vec_id")

ENTITIES = [USER, SUPPLIER, CUSTOMER, FLAG, NATION, VECTOR]

# Fixed clock of the lookups, just after the last event.
NOW = datetime(2024, 1, 31)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; its footer is read for the schema only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def store(spark: SparkSession, *definitions, limits: Limits = DEFAULT_LIMITS, key_ttl=None):
    """A store with a folder of its own."""
    fs = FeatureStore(spark, limits=limits, key_ttl=key_ttl)
    fs.apply(ENTITIES, *definitions)
    return fs


# -- events ---------------------------------------------------------------------


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine: every purchase."""
    events = table(spark, sf_dir, "events")
    return events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")


def events_with_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, with the time they became known: up to four hours later."""
    events = table(spark, sf_dir, "events")
    delay = F.make_dt_interval(F.lit(0), (F.col("event_id") % 5).cast("int"))
    return events.withColumn("created", F.col("ts") + delay)


def activity_source(sf_dir: str) -> QuerySource:
    def read(spark: SparkSession) -> DataFrame:
        return table(spark, sf_dir, "events").filter(F.col("event_type") != "purchase")

    return QuerySource(name="activity", query=read, event_timestamp_column="ts")


def activity(sf_dir: str, ttl: timedelta | None = None, name: str = "activity") -> FeatureView:
    """What a user last did other than purchase."""
    features = [Feature("value", "double"), Feature("event_type", "string")]
    return FeatureView(name, ["user"], activity_source(sf_dir), features, ttl)


def all_events_source(sf_dir: str) -> FileSource:
    return FileSource(
        name="events", path=f"{sf_dir}/events.parquet", event_timestamp_column="ts"
    )


def last_event(sf_dir: str, ttl: timedelta | None = None, name: str = "last_event") -> FeatureView:
    """A user's latest event, known with a delay."""
    source = QuerySource(
        name=f"{name}_source",
        query=lambda spark: events_with_created(spark, sf_dir),
        event_timestamp_column="ts",
        created_timestamp_column="created",
    )
    features = [Feature("value", "double"), Feature("event_type", "string")]
    return FeatureView(name, ["user"], source, features, ttl)


def daily_totals(sf_dir: str, ttl: timedelta | None = None) -> FeatureView:
    """Totals of each day, usable from the next day on; no entity."""

    def read(spark: SparkSession) -> DataFrame:
        day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
        return (
            table(spark, sf_dir, "events")
            .groupBy((day + F.expr("INTERVAL 1 DAY")).alias("day"))
            .agg(
                F.count(F.lit(1)).alias("n_events"),
                F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"),
            )
        )

    source = QuerySource(name="daily_totals", query=read, event_timestamp_column="day")
    features = [Feature("n_events", "bigint"), Feature("total_value", "double")]
    return FeatureView("daily_totals", [], source, features, ttl)


# -- orders and lines -------------------------------------------------------------


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine: every order line when it ships."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate"
    )


def supplier_lines(sf_dir: str) -> FeatureView:
    """Single lines per supplier and day: many ties, told apart by the created time."""

    def read(spark: SparkSession) -> DataFrame:
        delay = F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 7).cast("int"))
        return table(spark, sf_dir, "lineitem").withColumn("created", F.col("l_shipdate") + delay)

    source = QuerySource(
        name="supplier_lines",
        query=read,
        event_timestamp_column="l_shipdate",
        created_timestamp_column="created",
    )
    features = [Feature("l_quantity", "double"), Feature("l_extendedprice", "double")]
    return FeatureView("supplier_lines", ["supplier"], source, features)


def supplier_daily_sql(sf_dir: str) -> str:
    return f"""
        SELECT l_suppkey, l_shipdate, sum(l_quantity) AS day_quantity, count(*) AS day_lines
        FROM parquet.`{sf_dir}/lineitem.parquet`
        GROUP BY l_suppkey, l_shipdate
    """


def supplier_daily(sf_dir: str, ttl: timedelta | None = None) -> FeatureView:
    """Quantity and lines per supplier and day, from SQL text."""
    source = QuerySource(
        name="supplier_daily", query=supplier_daily_sql(sf_dir), event_timestamp_column="l_shipdate"
    )
    features = [Feature("day_quantity", "double"), Feature("day_lines", "bigint")]
    return FeatureView("supplier_daily", ["supplier"], source, features, ttl)


def supplier_returns(sf_dir: str, ttl: timedelta | None = None) -> FeatureView:
    """Returned quantity per supplier and day."""

    def read(spark: SparkSession) -> DataFrame:
        returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
        return returned.groupBy("l_suppkey", "l_shipdate").agg(
            F.sum("l_quantity").alias("returned_quantity")
        )

    source = QuerySource(name="supplier_returns", query=read, event_timestamp_column="l_shipdate")
    features = [Feature("returned_quantity", "double")]
    return FeatureView("supplier_returns", ["supplier"], source, features, ttl)


def supplier_flag_daily(sf_dir: str) -> FeatureView:
    """Quantity per supplier, return flag and day."""

    def read(spark: SparkSession) -> DataFrame:
        return (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_suppkey", "l_returnflag", "l_shipdate")
            .agg(F.sum("l_quantity").alias("flag_quantity"))
        )

    source = QuerySource(
        name="supplier_flag_daily", query=read, event_timestamp_column="l_shipdate"
    )
    features = [Feature("flag_quantity", "double")]
    return FeatureView("supplier_flag_daily", ["supplier", "return_flag"], source, features)


def customer_daily(sf_dir: str, ttl: timedelta | None = None) -> FeatureView:
    """Orders and spending per customer and day."""

    def read(spark: SparkSession) -> DataFrame:
        spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
        return (
            table(spark, sf_dir, "orders")
            .groupBy("o_custkey", "o_orderdate")
            .agg(spent.alias("day_spent"), F.count(F.lit(1)).alias("day_orders"))
        )

    source = QuerySource(name="customer_daily", query=read, event_timestamp_column="o_orderdate")
    features = [Feature("day_spent", "double"), Feature("day_orders", "bigint")]
    return FeatureView("customer_daily", ["customer"], source, features, ttl)


def customer_orders(sf_dir: str) -> FeatureView:
    """Single orders per customer; some become known days after later ones."""

    def read(spark: SparkSession) -> DataFrame:
        delay = F.make_dt_interval((F.col("o_orderkey") % 5).cast("int"))
        return table(spark, sf_dir, "orders").withColumn("created", F.col("o_orderdate") + delay)

    source = QuerySource(
        name="customer_orders",
        query=read,
        event_timestamp_column="o_orderdate",
        created_timestamp_column="created",
    )
    features = [Feature("o_totalprice", "double"), Feature("o_orderstatus", "string")]
    return FeatureView("customer_orders", ["customer"], source, features)


def lines_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine: every order line with its customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines(spark, sf_dir)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey", "l_shipdate")
    )


def lines_with_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine: every order line with the nations of its customer and its supplier."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("customer_nation")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("supplier_nation")
    )
    return (
        lines_with_customer(spark, sf_dir)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "customer_nation", "supplier_nation", "l_shipdate")
    )


def nation_daily(sf_dir: str, ttl: timedelta | None = None) -> FeatureView:
    """Orders per customer nation and day."""

    def read(spark: SparkSession) -> DataFrame:
        customer = table(spark, sf_dir, "customer")
        return (
            table(spark, sf_dir, "orders")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("c_nationkey").alias("nation"), F.col("o_orderdate"))
            .agg(F.count(F.lit(1)).alias("nation_orders"))
        )

    source = QuerySource(name="nation_daily", query=read, event_timestamp_column="o_orderdate")
    return FeatureView(
        "nation_daily", ["nation"], source, [Feature("nation_orders", "bigint")], ttl
    )
