"""Mixing sources to target weights by Poisson replication.

A document of a source with rate r is repeated k times, k drawn from a Poisson distribution
of mean r by inverting its distribution function at a number hashed from seed and id.  The
draw depends on nothing else, so a lost task repeats it exactly and no counts are exchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

PART_RATE = 16.0
STEPS = 96  # the distribution function of mean 16 is 1 in doubles well before this step
BROADCAST_SOURCES = 10_000


def source_rates(docs: DataFrame, temperature: float = 0.5, source: str = "source") -> DataFrame:
    """(source, rate): sources weighted by their size to the power ``temperature``.

    The expected number of documents stays the same.  1 keeps the given proportions, 0
    gives every source the same weight.  A null source is a source of its own.  One
    aggregation, combined before the shuffle, so a source with most rows is no hot group.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    total = sizes.agg(F.sum("n").alias("all_rows"), F.sum(F.pow("n", F.lit(temperature))).alias("all_weights"))
    share = F.pow("n", F.lit(temperature)) / F.col("all_weights")
    # one row beside each source
    return sizes.crossJoin(F.broadcast(total)).select("source", (share * F.col("all_rows") / F.col("n")).alias("rate"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of a digest of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def _steps(rate: Column) -> Column:
    """Values of the distribution function of a mean of at most ``PART_RATE`` at 0, 1, 2, ..."""
    first = F.exp(-rate)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        F.struct(first.alias("p"), F.array(first).alias("f")),
        lambda s, k: F.struct(
            (s["p"] * rate / k).alias("p"),
            F.concat(s["f"], F.array(F.element_at(s["f"], -1) + s["p"] * rate / k)).alias("f"),
        ),
    )
    return walked["f"]


def mix(
    docs: DataFrame,
    rates: DataFrame,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """All columns of ``docs``, each row repeated by its draw, in a global random order.

    ``rates`` is (source, rate), one row per source.  ``copy`` numbers the copies of a row
    from 0 and ``mix_key`` is what rows are dealt and sorted by.  Sources without a rate, or
    with a rate of zero or less, vanish.  Null ids draw by the digest of their text; equal
    rows draw alike.  Columns named like the two new ones are replaced.
    A rate above 16 is the sum of independent draws of smaller mean, so any rate is exact.
    """
    given = [c for c in docs.columns if c not in ("copy", "mix_key")]
    # neutral names, so that no column of the caller can clash with one made here
    names = [f"__column{i}" for i in range(len(given))]
    clean = docs.select(*[F.col(f"`{c}`") for c in given]).toDF(*names)
    doc_id, text, source = (names[given.index(c)] for c in (doc_id, text, source))
    parts = F.ceil(F.col("rate") / PART_RATE)
    table = rates.filter("rate > 0").select(
        F.col("source").alias("_source"),
        parts.cast("int").alias("_parts"),
        _steps(F.col("rate") / parts).alias("_steps"),
    )
    # The rates are few in practice; their number decides, and beyond it Spark joins by shuffle.
    table = stored(table, "rates")
    if table.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    name = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    joined = clean.join(table, F.col(source).eqNullSafe(F.col("_source")))
    draws = F.transform(
        F.sequence(F.lit(1), F.col("_parts")),
        lambda j: F.size(F.filter("_steps", lambda x: x <= _uniform(F.lit(seed), name, j.cast("string")))),
    )
    times = F.aggregate(draws, F.lit(0), lambda a, b: a + b)
    if_one = F.size(F.filter("_steps", lambda x: x <= F.col("_u")))
    counted = joined.withColumn("_u", _uniform(F.lit(seed), name, F.lit("1"))).withColumn(
        "_times", F.when(F.col("_parts") == 1, if_one).otherwise(times)
    )
    copies = (
        counted.filter("_times > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
        .select(*names, "copy", F.md5(F.concat_ws(":", F.lit(seed), name, "copy").cast("binary")).alias("mix_key"))
    )
    return copies.repartition("mix_key").sortWithinPartitions("mix_key").toDF(*given, "copy", "mix_key")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or dropped so that sources weigh as the roots of their sizes; two columns more."""
    return mix(docs, source_rates(docs))


def expected_steps(rate: float) -> list[float]:
    """The same steps in plain Python, for tests."""
    p = math.exp(-rate)
    out = [p]
    for k in range(1, STEPS + 1):
        p = p * rate / k
        out.append(out[-1] + p)
    return out


ORACLE = f"""
WITH RECURSIVE n AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY source),
r AS (SELECT source, pow(n, 0.5) / (SELECT sum(pow(n, 0.5)) FROM n) * (SELECT sum(n) FROM n) / n AS rate FROM n),
f AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS f FROM r
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), f + p * rate / (k + 1) FROM f WHERE k < {STEPS}),
u AS (
  SELECT *, ('0x' || substr(md5('mix:' || doc_id || ':1'), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)} AS u
  FROM documents),
t AS (
  SELECT doc_id, any_value(text) AS text, any_value(lang) AS lang, any_value(u.source) AS source,
         any_value(n_chars) AS n_chars, count(*) AS times
  FROM u JOIN f ON u.source IS NOT DISTINCT FROM f.source AND f.f <= u.u GROUP BY doc_id)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, md5('mix:' || doc_id || ':' || copy) AS mix_key
FROM (SELECT *, unnest(range(0, times)) AS copy FROM t)
"""
