"""Finding keys that hold too many rows for one task, and cutting them by time.

The statistics come from a sample, so they are cheap; they only choose where a hot
key is cut.  Every row still takes part in the join, and a wrong guess costs balance,
never a result.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_not_null, q
from tidemark.functions.times import epoch_seconds
from tidemark.plans.sizes import Limits, is_small, scanned_bytes

_VALUE = "__ft_number"
_FOUND = "__ft_found"

# A guess; see draw_sample.
_BYTES_PER_ROW = 40

# Sampled rows by which a key at the bound is told from smaller ones, to about two per cent.
_ROWS_PER_HOT_KEY = 2000


@dataclass(frozen=True)
class Skew:
    """Hot keys (by hash) and the time edges that cut each of them.

    ``hot`` is None when there are no keys at all, i.e. every row is in one group.  Rows
    are placed on one line: the rank of their key plus their time as a share of the
    sampled span, so a slice belongs to one key and slices of a key follow its time.
    ``edges`` cut that line.  ``tied`` says that one single event time holds a whole
    slice's worth of rows, so that cutting by time alone would leave a large group.
    """

    hot: tuple[int, ...] | None
    edges: tuple[float, ...]
    tied: bool = False
    start: float = 0.0
    span: float = 1.0

    @property
    def slices(self) -> int:
        return len(self.edges) + 1

    def last_slice(self, rank: int) -> int:
        return bisect.bisect_left(self.edges, rank + 1.0)

    def place(self, seconds: Column) -> Column:
        """Share of the span; order is kept, and times beyond the sample's stay inside."""
        share = (seconds - F.lit(self.start)) / F.lit(self.span)
        return F.greatest(F.lit(0.0), F.least(share, F.lit(_ALMOST_ONE)))


# Below one by more than the rounding of a rank and a share added up.
_ALMOST_ONE = 1.0 - 1e-9
_HASH, RANK, LAST = "__ft_hash", "__ft_rank", "__ft_last"


def ranked(df: DataFrame, keys: list[str], skew: Skew) -> DataFrame:
    """Adds the rank of a row's key among the hot ones and its last slice; null for others.

    The hot keys, at most ``max_hot_keys``, are sent to every task.
    """
    if skew.hot is None:
        return df.withColumns({RANK: F.lit(0), LAST: F.lit(skew.last_slice(0))})
    rows = [(h, r, skew.last_slice(r)) for r, h in enumerate(skew.hot)]
    table = df.sparkSession.createDataFrame(rows, f"{_HASH} bigint, {RANK} int, {LAST} int")
    return df.join(F.broadcast(table), F.xxhash64(*[q(k) for k in keys]) == q(_HASH), "left").drop(_HASH)


def with_slice(df: DataFrame, keys: list[str], ts: str, skew: Skew, name: str) -> DataFrame:
    """Add the number of the slice a row falls into, -1 for keys that are not hot."""
    seconds = epoch_seconds(q(ts), df.schema[ts].dataType)
    placed = ranked(df, keys, skew)
    sliced = with_range(placed, q(RANK) + skew.place(seconds), skew.edges, name)
    found = F.when(q(RANK).isNotNull(), q(name)).otherwise(F.lit(-1))
    return sliced.withColumn(name, found).drop(RANK, LAST)


def with_range(df: DataFrame, value: Column, edges, name: str) -> DataFrame:
    """Add the number of the range a value falls into (binary search in the JVM)."""
    if not edges:
        return df.withColumn(name, F.lit(0))
    bucketizer = Bucketizer(
        splits=[-math.inf, *edges, math.inf],
        inputCol=_VALUE,
        outputCol=_FOUND,
        handleInvalid="keep",
    )
    ranged = bucketizer.transform(df.withColumn(_VALUE, F.coalesce(value, F.lit(0.0))))
    return ranged.withColumn(name, q(_FOUND).cast("int")).drop(_VALUE, _FOUND)


def find_skew(points: DataFrame, keys: list[str], ts: str, limits: Limits) -> Skew | None:
    """Look for hot keys among ``points`` (all rows that will meet in one window).

    One pass over the key and time columns draws a sample, which is kept for the two
    questions asked of it: rows per key (at most ``max_hot_keys`` keys come back) and
    time quantiles of the hot rows.  Returns None if no key is hot.
    """
    sample, rows, fraction = draw_sample(points.filter(all_not_null(keys)), limits)
    try:
        total = rows / fraction
        if total <= limits.group_rows:
            return None
        share = max(limits.group_rows / total, 1.0 / limits.max_hot_keys)
        # few rows tell whether a key has a large share, and every row costs a shuffle
        thin = min(1.0, _ROWS_PER_HOT_KEY / share / max(rows, 1))
        thinned = sample if thin >= 1.0 else sample.sample(fraction=thin, seed=19)
        counts = (
            thinned.select(F.xxhash64(*[q(k) for k in keys]).alias("h"))
            .groupBy("h")
            .count()
            .filter(F.col("count") >= share * rows * thin)
            .collect()
        )
        if not counts:
            return None
        return _cut_keys(sample, keys, ts, counts, fraction * thin, limits)
    finally:
        sample.unpersist()


def _cut_keys(
    sample: DataFrame, keys: list[str], ts: str, counts: list, fraction: float, limits: Limits
) -> Skew:
    """Cuts every hot key at quantiles of its own event times.

    Keys that need about as many parts are looked at in one job over the sample; all
    edges together are about twice the rows of hot keys over ``group_rows``.
    """
    hot = tuple(sorted(r["h"] for r in counts))
    seconds = epoch_seconds(q(ts), sample.schema[ts].dataType)
    timed = sample.filter(q(ts).isNotNull())
    ends = timed.agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi")).first()
    start = ends["lo"] or 0.0
    bare = Skew(hot, (), start=start, span=max((ends["hi"] or 0.0) - start, 1.0) * (1 + 1e-6))
    line = ranked(timed, keys, bare).filter(q(RANK).isNotNull())
    line = line.select(q(RANK), (q(RANK) + bare.place(seconds)).alias("v"))
    classes: dict[int, list[int]] = {}
    place = {h: r for r, h in enumerate(hot)}
    for row in counts:
        parts = _parts(row["count"] / fraction, 2, limits)
        classes.setdefault(1 << (parts - 1).bit_length(), []).append(place[row["h"]])
    edges = {float(r) for r in range(1, len(hot))}
    tied = False
    for parts, ranks in classes.items():
        chosen = line if len(classes) == 1 else line.filter(q(RANK).isin(ranks))
        for row in chosen.groupBy(RANK).agg(_quantiles(q("v"), parts).alias("e")).toLocalIterator():
            found = row["e"] or []
            tied = tied or len(set(found)) < len(found)
            edges.update(found)
    return replace(bare, edges=tuple(sorted(edges)), tied=tied)


def cut_time_line(points: DataFrame, ts: str, limits: Limits) -> Skew:
    """Slices for rows without keys, which would otherwise all meet in one group."""
    if is_small(limits, points):
        return _cut_line(points, ts, limits.min_slices)
    sample, rows, fraction = draw_sample(points, limits)
    try:
        return _cut_line(sample, ts, _parts(rows / fraction, limits.min_slices, limits))
    finally:
        sample.unpersist()


def range_edges(values: DataFrame, column: str, limits: Limits) -> list[float]:
    """Where to cut a numeric column into ranges of bounded size."""
    as_double = q(column).cast("double")
    if is_small(limits, values):
        return sorted(set(quantile_edges(values, as_double, limits.min_slices)))
    sample, rows, fraction = draw_sample(values, limits)
    try:
        n = _parts(rows / fraction, limits.min_slices, limits)
        return sorted(set(quantile_edges(sample, as_double, n)))
    finally:
        sample.unpersist()


def _parts(rows: float, least: int, limits: Limits) -> int:
    return min(limits.max_slices, max(least, math.ceil(rows / limits.group_rows)))


def _cut_line(df: DataFrame, ts: str, n: int) -> Skew:
    seconds = epoch_seconds(q(ts), df.schema[ts].dataType)
    found = quantile_edges(df.filter(q(ts).isNotNull()), seconds, n)
    if not found:
        return Skew(None, ())
    start, span = found[0], max(found[-1] - found[0], 1.0) * 2
    # The outer quarters of the line hold the times before the first edge and after the last.
    edges = sorted({0.25 + (x - start) / span for x in found})
    return Skew(None, tuple(edges), len(edges) < len(found), start - span / 4, span)


def quantile_edges(df: DataFrame, value: Column, n: int) -> list[float]:
    """The n - 1 values that cut a column into n parts of about equal size."""
    return df.agg(_quantiles(value, n).alias("e")).first()["e"] or []


def _quantiles(value: Column, n: int) -> Column:
    return F.percentile_approx(value, [i / n for i in range(1, n)], 20 * n)


def draw_sample(points: DataFrame, limits: Limits) -> tuple[DataFrame, int, float]:
    """A stored sample of about ``sample_rows`` rows, its size and its fraction.

    How many rows there are is guessed from the bytes read instead of being counted; a
    sample that came out too small is drawn again with a larger fraction, one that came
    out too large is thinned.
    """
    size = scanned_bytes(points)
    guess = limits.sample_rows * 100 if size is None else size / _BYTES_PER_ROW
    fraction = min(1.0, limits.sample_rows / max(guess, 1.0))
    while True:
        drawn = points if fraction >= 1.0 else points.sample(fraction=fraction, seed=17)
        drawn = drawn.persist(StorageLevel.MEMORY_AND_DISK)
        rows = drawn.count()
        if rows > 4 * limits.sample_rows:
            share = limits.sample_rows / rows
            thinned = drawn.sample(fraction=share, seed=18).persist(StorageLevel.MEMORY_AND_DISK)
            rows = thinned.count()
            drawn.unpersist()
            return thinned, rows, fraction * share
        if fraction >= 1.0 or rows * 10 >= limits.sample_rows:
            return drawn, rows, fraction
        drawn.unpersist()
        fraction = min(1.0, fraction * min(1000.0, limits.sample_rows / max(rows, 1)))
