"""Profiles of the parts of a growing dataset, kept and merged on demand.

Every part, such as a day, is profiled once: counts, sums and extremes, and sketches of the
distinct values and of the distribution of numbers.  All of these can be merged, so the
profile of any set of parts costs a few rows per part, and a dataset that grew by a day is
profiled by reading that day.

Distinct counts come from HyperLogLog sketches (standard error 1.6 % at 2^12 registers);
quantiles from KLL sketches of 200 (rank error about 1.3 %).  Counts and extremes are exact,
extremes in the column's own type.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import SmallFiles
from tidemark.functions.columns import orderable, q

PART = "part"
_ROWS = "rows"
_SEQ = "seq"
_LG_REGISTERS = 12
_KLL = 200


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def _names(i: int) -> dict[str, str]:
    return {k: f"c{i}_{k}" for k in ("present", "min", "max", "sum", "distinct", "quantiles")}


def part_profiles(df: DataFrame, part: Column, columns: list[str] | None = None) -> DataFrame:
    """One row per part with all that is needed to merge profiles.  One aggregation."""
    columns = columns or df.columns
    stats: list[Column] = [F.count(F.lit(1)).alias(_ROWS)]
    for i, c in enumerate(columns):
        dtype, name = df.schema[c].dataType, _names(i)
        stats.append(F.count(q(c)).alias(name["present"]))
        if orderable(dtype):
            stats += [F.min(q(c)).alias(name["min"]), F.max(q(c)).alias(name["max"])]
        if isinstance(dtype, (T.MapType, T.VariantType, T.StructType, T.ArrayType)):
            continue
        # of values in one form for all types
        stats.append(F.hll_sketch_agg(q(c).cast("string"), F.lit(_LG_REGISTERS)).alias(name["distinct"]))
        if _is_number(dtype):
            stats.append(F.sum(q(c).cast("double")).alias(name["sum"]))
            stats.append(F.kll_sketch_agg_double(q(c).cast("double"), F.lit(_KLL)).alias(name["quantiles"]))
    return df.groupBy(part.alias(PART)).agg(*stats)


def merged(parts: DataFrame, columns: list[str], types: dict[str, T.DataType], probabilities: list[float]) -> DataFrame:
    """Per column the profile of all given parts together: one aggregation of sketches."""
    have = set(parts.columns)
    stats: list[Column] = [F.sum(_ROWS).alias("n")]
    rows = []
    for i, c in enumerate(columns):
        name = _names(i)
        stats.append(F.sum(name["present"]).alias(name["present"]))
        for key, merge in (("min", F.min), ("max", F.max), ("sum", F.sum)):
            if name[key] in have:
                stats.append(merge(q(name[key])).alias(name[key]))
        if name["distinct"] in have:
            stats.append(F.hll_sketch_estimate(F.hll_union_agg(name["distinct"])).alias(name["distinct"]))
        if name["quantiles"] in have:
            stats.append(F.kll_merge_agg_double(name["quantiles"]).alias(name["quantiles"]))

        def known(key: str, dtype: str, name=name) -> Column:
            return q(name[key]).cast(dtype) if name[key] in have else F.lit(None).cast(dtype)

        wanted = F.array(*[F.lit(p) for p in probabilities])
        quantiles = F.lit(None).cast("array<double>")
        if name["quantiles"] in have:
            some = F.kll_sketch_get_n_double(name["quantiles"]) > 0
            quantiles = F.when(some, F.kll_sketch_get_quantile_double(name["quantiles"], wanted))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c].simpleString()).alias("column_type"),
                q("n").alias("row_count"),
                (q("n") - q(name["present"])).alias("null_count"),
                known("distinct", "bigint").alias("distinct_estimate"),
                known("min", "string").alias("min_text"),
                known("max", "string").alias("max_text"),
                (known("sum", "double") / F.nullif(q(name["present"]), F.lit(0))).alias("mean_value"),
                quantiles.alias("quantiles"),
            )
        )
    return parts.agg(*stats).select(F.inline(F.array(*rows)))


class PartProfiles:
    """Stored profiles of the parts of one dataset, below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.files = SmallFiles(spark)

    def _stored(self) -> tuple[DataFrame | None, list[str], T.StructType | None]:
        names = [n for n in self.files.names(f"{self.folder}/_log") if n.endswith(".json")]
        if not names:
            return None, [], None
        held = [json.loads(self.files.read(f"{self.folder}/_log/{n}")) for n in names]
        frames = [
            self.spark.read.schema(T.StructType.fromJson(json.loads(h["schema"]))).parquet(f"{self.folder}/{h['folder']}") for h in held
        ]
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        # a part that was profiled again counts once
        newest = union.groupBy(PART).agg(F.max(_SEQ).alias(_SEQ))
        rows = union.join(newest, [PART, _SEQ], "left_semi")
        return rows, held[-1]["columns"], T.StructType.fromJson(json.loads(held[-1]["types"]))

    def parts(self) -> list:
        """The parts known so far; as many values as there are parts."""
        rows, _, _ = self._stored()
        return [] if rows is None else sorted(r[0] for r in rows.select(PART).distinct().collect())

    def update(self, df: DataFrame, part: Column, columns: list[str] | None = None, again: list = ()) -> None:
        """Profile the parts of ``df`` that are not known yet, and those in ``again``.

        Known parts are left out by a filter on ``part`` that reaches the scan.
        """
        rows, names, known_types = self._stored()
        columns = list(columns or df.columns)
        types = T.StructType([df.schema[c] for c in columns])
        if rows is not None and [columns, types.simpleString()] != [names, known_types.simpleString()]:
            raise ValueError("the stored profiles are of other columns or types")
        known = [p for p in self.parts() if p not in set(again)]
        new = df.filter(part.isNotNull() & ~part.isin(known)) if known else df.filter(part.isNotNull())
        found = part_profiles(new, part, columns).withColumn(_SEQ, F.lit(time.time_ns()))
        folder = uuid.uuid4().hex
        found.write.parquet(f"{self.folder}/{folder}")
        entry = {"folder": folder, "schema": found.schema.json(), "columns": columns, "types": types.json()}
        self.files.add(f"{self.folder}/_log", f"{time.time_ns():020d}-{folder}.json", json.dumps(entry))

    def profile(self, condition: Column | None = None, probabilities: list[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        """The merged profile of all parts, or of those that meet a condition on ``part``."""
        rows, columns, types = self._stored()
        if rows is None:
            raise ValueError("nothing was profiled yet")
        rows = rows if condition is None else rows.filter(condition)
        return merged(rows, columns, {f.name: f.dataType for f in types}, list(probabilities))
