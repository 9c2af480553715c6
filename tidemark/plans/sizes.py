"""How large an input is, as far as it is known before a job runs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Limits:
    """Bounds that decide between plan shapes; every result is the same either way.

    small_bytes    inputs estimated below this may meet in a single group
    group_rows     rows one window group should not exceed by much
    min_slices     parts a time line or a column is cut into at least
    max_slices     most parts a hot key, a time line or a column is cut into
    sample_rows    rows looked at when searching for hot keys and slice edges
    max_hot_keys   1 / the smallest share of all rows that makes a key hot
    exact_keys     keys asked for that become literals of a filter
    few_points     (key, time) points of a spine that are looked up by broadcast
    filter_words   most 64-bit words of a Bloom filter on keys
    bucket_bytes   bytes of a snapshot folder that make up a bucket of the key
    max_buckets    most buckets of a folder (a power of two)
    """

    small_bytes: int = 256 * 1024 * 1024
    group_rows: int = 5_000_000
    min_slices: int = 16
    max_slices: int = 4096
    sample_rows: int = 4_000_000
    max_hot_keys: int = 20_000
    exact_keys: int = 1000
    few_points: int = 200_000
    filter_words: int = 1 << 20
    bucket_bytes: int = 64 * 1024 * 1024
    max_buckets: int = 1024


DEFAULT_LIMITS = Limits()

# Spark's default size of an input without statistics lies far above this.
_NO_ESTIMATE = 1 << 60


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a DataFrame, or None where there is none.

    An upper bound for scans, filters and aggregates, and far too high after joins.  No
    job runs for it.
    """
    plans = _plans(df)
    return None if plans is None else _size(plans.optimizedPlan())


def scanned_bytes(df: DataFrame) -> int | None:
    """Size of everything a DataFrame reads, or None if unknown.  No job runs for it."""
    plans = _plans(df)
    if plans is None:
        return None
    leaves = plans.analyzed().collectLeaves()
    sizes = [_size(leaves.apply(i)) for i in range(leaves.size())]
    return None if any(size >= _NO_ESTIMATE for size in sizes) else sum(sizes)


def known_bytes(df: DataFrame) -> int | None:
    """The smaller of what a DataFrame is estimated to hold and what it reads, or None."""
    sizes = (estimated_bytes(df), scanned_bytes(df))
    return min((x for x in sizes if x is not None and x < _NO_ESTIMATE), default=None)


def _plans(df: DataFrame):
    try:
        return df._jdf.queryExecution()
    except (AttributeError, NotImplementedError):
        return None


def _size(plan) -> int:
    return int(str(plan.stats().sizeInBytes()))


# Plan nodes whose output Catalyst cannot estimate: generators and functions of the caller.
_GENERATORS = re.compile(r"\b(Generate|Expand|MapIn\w+|MapPartitions|FlatMap\w*)\b")
_EQUALITY = re.compile(r"<=>|[^<>!]=")


def _plan_lines(df: DataFrame) -> list[str]:
    plans = _plans(df)
    return [] if plans is None else plans.analyzed().toString().splitlines()


def is_small(limits: Limits, *dfs: DataFrame) -> bool:
    """Whether all inputs together are estimated to stay below ``small_bytes``.

    Joins on keys seldom make more rows than they read, whatever the estimate says, so
    inputs that read very little count as small without one, unless a join has no
    equality.  What generators and callers' functions make is never known to be small.
    """
    lines = [line for df in dfs for line in _plan_lines(df)]
    if any(_GENERATORS.search(line) for line in lines):
        return False
    plain = all(_EQUALITY.search(line) for line in lines if re.search(r"\bJoin\b", line))
    for measure, bound in (
        (scanned_bytes, limits.small_bytes // 4),
        (estimated_bytes, limits.small_bytes),
    ):
        if measure is scanned_bytes and not plain:
            continue
        sizes = [measure(df) for df in dfs]
        if None not in sizes and sum(sizes) <= bound:
            return True
    return False
