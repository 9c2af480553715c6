"""Saved datasets, profiles and checks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import TableStorage
from tidemark.operators import quality as dq
from tidemark.operators.profiles import PartProfiles
from tidemark.operators.quantiles import exact_quantiles
from tidemark.session import shared_folder
from workloads import views as v
from workloads.training import REFS, TTL


def _early(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = v.table(spark, sf_dir, "orders")
    return orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))


def saved_dataset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.activity(sf_dir, TTL))
    job = fs.get_historical_features(v.purchases(spark, sf_dir), REFS)
    fs.create_saved_dataset(job, "purchases", tags={"owner": "workloads"})
    return fs.get_saved_dataset("purchases").to_spark_df(spark)


def persist_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = v.store(spark, v.supplier_daily(sf_dir))
    refs = ["supplier_daily:day_quantity", "supplier_daily:day_lines"]
    job = fs.get_historical_features(v.lines(spark, sf_dir), refs)
    folder = shared_folder(spark, "table")
    name = "lines_" + folder.rstrip("/").rsplit("-", 1)[-1].replace(".", "_")
    storage = TableStorage(name, path=f"{folder}/{name}")
    job.persist(storage)
    return storage.read(spark)


def _summary(report: DataFrame) -> DataFrame:
    return report.select(
        "position",
        "check_name",
        "column_name",
        "success",
        F.round("observed", 4).alias("observed"),
        "unexpected_count",
        "missing_count",
        F.round("missing_percent", 4).alias("missing_percent"),
    )


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = dq.column_profile(v.table(spark, sf_dir, "lineitem"))
    return profile.select(
        "column_name",
        "row_count",
        "null_count",
        "min_value",
        "max_value",
        F.round("mean_value", 3).alias("mean_value"),
        "min_text",
        "max_text",
        "distinct_estimate",
    )


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile, with the number of values and whether its estimate is within 15 % of it."""
    lines = v.table(spark, sf_dir, "lineitem")
    exact = F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("n_values")) for c in lines.columns])
    counted = lines.agg(exact.alias("exact")).select(F.inline("exact"))
    near = F.abs(F.col("distinct_estimate") - F.col("n_values")) <= 0.15 * F.col("n_values")
    return _profile(spark, sf_dir).join(counted, "column_name").withColumn("estimate_near", near).drop("distinct_estimate")


def dq_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of single days, the later ones added in a second run, merged into one.

    The estimates are compared with the exact numbers: distinct values within 5 %, and the
    share of rows up to each quantile within 0.04 of what was asked for.
    """
    events = v.table(spark, sf_dir, "events")
    profiles = PartProfiles(spark, shared_folder(spark, "profiles"))
    day = F.col("ts").cast("date")
    profiles.update(events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")), day)
    profiles.update(events, day)
    asked = [0.1, 0.5, 0.9]
    found = profiles.profile(probabilities=asked)
    exact = F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("n_values")) for c in events.columns])
    found = found.join(events.agg(exact.alias("exact")).select(F.inline("exact")), "column_name")
    cuts = found.filter("column_name = 'value'").select(F.posexplode("quantiles").alias("i", "cut"))
    # three rows
    ranks = events.join(F.broadcast(cuts), F.col("value") <= F.col("cut"), "inner").groupBy("i").agg(F.count(F.lit(1)).alias("below"))
    total = events.agg(F.count("value").alias("n"))
    share = F.get(F.array(*[F.lit(p) for p in asked]), F.col("i"))
    off = ranks.join(F.broadcast(total)).agg(F.max(F.abs(F.col("below") / F.col("n") - share)).alias("off"))
    return found.join(F.broadcast(off)).select(
        "column_name",
        "row_count",
        "null_count",
        "n_values",
        (F.abs(F.col("distinct_estimate") - F.col("n_values")) <= 0.05 * F.col("n_values")).alias("estimate_near"),
        F.when(F.col("column_name").isin("event_id", "user_id", "event_type"), F.col("min_text")).alias("min_text"),
        F.when(F.col("column_name").isin("event_id", "user_id", "event_type"), F.col("max_text")).alias("max_text"),
        F.round("mean_value", 3).alias("mean_value"),
        F.when(F.col("column_name") == "value", F.col("off") <= 0.04).alias("quantiles_near"),
    )


PASSING = [
    dq.values_not_null("o_custkey"),
    dq.values_between("o_totalprice", 0, 1_000_000),
    dq.values_in_set("o_orderstatus", ["F", "O", "P"]),
    dq.min_between("o_totalprice", 0, None),
    dq.max_between("o_totalprice", None, 1_000_000),
    dq.values_between("o_orderdate", "1990-01-01T00:00:00", None),
    dq.values_in_types("o_orderkey", ["bigint"]),
]

FAILING = [
    dq.max_between("o_totalprice", -1000, -100),
    dq.values_in_set("o_orderstatus", ["F"]),
    dq.min_between("o_totalprice", 0, 1_000_000),
    dq.mean_between("o_totalprice", 0, 10),
    dq.values_between("o_totalprice", 0, 100_000, mostly=0.9),
    dq.values_in_types("o_orderkey", ["string"]),
]


def dq_validate_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(dq.report(v.table(spark, sf_dir, "orders"), PASSING))


def dq_validate_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(dq.failures(v.table(spark, sf_dir, "orders"), FAILING))


PROBABILITIES = [0.1, 0.25, 0.5, 0.75, 0.9]


def dq_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_quantiles(v.table(spark, sf_dir, "lineitem"), "l_extendedprice", PROBABILITIES)
    return found.select(
        *[F.get("quantiles", F.lit(i)).alias(f"q{int(p * 100)}") for i, p in enumerate(PROBABILITIES)]
    )


def dq_quantile_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the early orders, give or take a tenth, checked on all orders."""
    probabilities = [0.1, 0.25, 0.5, 0.9]
    early = exact_quantiles(_early(spark, sf_dir), "o_totalprice", probabilities).first()["quantiles"]
    near = [(0.9 * x, 1.1 * x) for x in early]
    checks = [
        dq.quantiles_between("o_totalprice", probabilities, near),
        dq.quantiles_between("o_totalprice", [0.25, 0.5], [(near[1][0], None), (None, 10)]),
    ]
    return _summary(dq.report(v.table(spark, sf_dir, "orders"), checks))


def dq_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expectations generated from the early orders, checked on all orders."""
    checks = dq.auto_profile(_early(spark, sf_dir), ["o_orderstatus", "o_orderpriority"])
    return _summary(dq.report(v.table(spark, sf_dir, "orders"), checks))


def dq_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved dataset as reference: its stored expectations judge a later retrieval."""
    fs = v.store(spark, v.activity(sf_dir))
    reference = fs.get_historical_features(v.purchases(spark, sf_dir), REFS)
    saved = fs.create_saved_dataset(reference, "reference")

    def profiler(df: DataFrame) -> list[dq.Expectation]:
        row = df.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()
        return [
            dq.values_between("value", row["lo"], row["hi"]),
            dq.values_not_null("event_type", 0.5),
        ]

    fs.as_reference(saved, profiler)
    stored = fs.as_reference(saved)
    later = v.store(spark, v.activity(sf_dir, TTL))
    job = later.get_historical_features(v.purchases(spark, sf_dir), REFS)
    return _summary(dq.report(job.df, list(stored.expectations)))


def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values joined at a time against a snapshot loaded too early, in which every tenth key is lost."""
    at, early = datetime(2024, 1, 20), datetime(2024, 1, 10)
    fs = v.store(spark, v.last_event(sf_dir))
    users = v.table(spark, sf_dir, "events").select("user_id").distinct()
    refs = ["last_event:value", "last_event:event_type"]
    spine = users.withColumn("asked", F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
    joined = fs.get_historical_features(spine, refs).df
    fs.materialize(datetime(2024, 1, 1), early, now=at)
    found = fs.get_online_features(refs, users.filter("user_id % 10 <> 0"), now=at, metadata=False)
    return dq.consistency_report(joined, found, ["user_id"], ["value", "event_type"])
