"""Looking entities up in a snapshot, many at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import q
from tidemark.operators.latest import CREATED_TS, EVENT_TS, latest_per_key


def request_keys(requests: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """The distinct keys of the requests, under the snapshot's column names."""
    return requests.select(*[q(r).alias(s) for r, s in keys]).distinct()


def lookup(
    requests: DataFrame,
    snapshot: DataFrame,
    keys: list[tuple[str, str]],
    name: str,
) -> DataFrame:
    """Left join on the key; adds the snapshot row as a struct, null if there is none.

    ``keys`` pairs request columns with snapshot columns.  The snapshot holds each key
    once, so repeated requests only fan out.  Without keys the snapshot is at most one
    row, which is sent to every task.
    """
    values = [c for c in snapshot.columns if c not in {s for _, s in keys}]
    packed = F.struct(*[q(v) for v in values]).alias(name)
    if not keys:
        # An aggregate without keys, so one row by construction.
        recency = [c for c in (EVENT_TS, CREATED_TS) if c in snapshot.columns]
        one = F.broadcast(latest_per_key(snapshot, [], recency).select(packed))
        return requests.join(one, F.lit(True), "left")
    right = snapshot.select(*[q(s).alias(f"__ft_s{i}") for i, (_, s) in enumerate(keys)], packed)
    condition = F.lit(True)
    for i, (r, _) in enumerate(keys):
        condition = condition & (q(r) == q(f"__ft_s{i}"))
    joined = requests.join(right, condition, "left")
    return joined.select(*[q(c) for c in requests.columns], q(name))


def status_counts(lookups: DataFrame, features: list[str], suffix: str = "__status") -> DataFrame:
    """How often each feature was found with which status: (feature, status, requests)."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), q(f + suffix).alias("status")) for f in features]
    )
    return (
        lookups.select(F.inline(pairs))
        .groupBy("feature", "status")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def request_sizes(lookups: DataFrame, request_id: str) -> DataFrame:
    """How many requests asked for how many rows: (rows, requests)."""
    per_request = lookups.groupBy(q(request_id)).agg(F.count(F.lit(1)).alias("rows"))
    return per_request.groupBy("rows").agg(F.count(F.lit(1)).alias("requests"))
