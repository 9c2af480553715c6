"""Exact quantiles without gathering a column in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import q
from tidemark.plans.sizes import DEFAULT_LIMITS, Limits
from tidemark.plans.skew import range_edges, with_range

_VALUE, _COUNT, _BUCKET = "__ft_value", "__ft_count", "__ft_bucket"


def exact_quantiles(
    df: DataFrame, column: str, probabilities: list[float], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """One row with ``quantiles``: the value at rank ``round((n - 1) * p)`` for each p.

    Half ranks round to the even one.  Nulls do not count.  Equal values are counted
    before the shuffle; the distinct values are cut into ranges at approximate quantiles,
    ranges are added up on their own, and a running total over the few ranges tells
    where each one starts.
    """
    values = df.select(q(column).alias(_VALUE)).filter(q(_VALUE).isNotNull())
    counts = values.groupBy(_VALUE).agg(F.count(F.lit(1)).alias(_COUNT))
    edges = range_edges(values, _VALUE, limits)
    counts = with_range(counts, q(_VALUE).cast("double"), edges, _BUCKET)

    ranges = counts.groupBy(_BUCKET).agg(F.sum(_COUNT).alias("__ft_size"))
    # At most max_slices rows, so one window group is fine here.
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        q(_BUCKET),
        F.coalesce(F.sum("__ft_size").over(before), F.lit(0)).alias("__ft_start"),
        F.sum("__ft_size").over(everything).alias("__ft_total"),
    )
    inside = Window.partitionBy(_BUCKET).orderBy(_VALUE)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("__ft_upto", F.sum(_COUNT).over(running)).join(
        F.broadcast(starts), _BUCKET
    )
    last = q("__ft_start") + q("__ft_upto")
    first = last - q(_COUNT)
    picked = []
    for p in probabilities:
        rank = F.bround((q("__ft_total") - 1) * F.lit(float(p)), 0)
        picked.append(F.max(F.when((rank >= first) & (rank < last), q(_VALUE))))
    return ranked.agg(F.array(*picked).alias("quantiles"))
