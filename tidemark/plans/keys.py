"""Leaving out rows whose key nobody asks for, before they are shuffled.

The keys asked for are counted roughly in one pass.  A few are read and become a filter of
literals, which reaches the scan.  More go into a Bloom filter: a table of 64-bit words in
which every key sets four bits of one word, built by one aggregate and sent to all tasks.
Its size follows the number of keys and is bounded; beyond the bound nothing is filtered.
It is built once, here, so that the plans it goes into do not work out the spine again.
A filter only ever leaves out rows that match nothing, so all ways give the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import all_not_null, q
from tidemark.plans.sizes import Limits

_SLOT = "__ft_slot"
_BITS = "__ft_bits"
_WORD = 64
_BITS_PER_KEY = 16
_FEWEST_BITS_PER_KEY = 4

# Rows that must share a point, on average, for looking points up to pay.
_ROWS_PER_POINT = 16

# Types whose values stand in a plan as they are, and types whose equal values hash alike.
_LITERALS = (T.IntegralType, T.StringType, T.BooleanType, T.DateType)
_HASHED = (*_LITERALS, T.FractionalType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


@dataclass(frozen=True)
class KeyFilter:
    """Which keys are asked for: exactly, or as a Bloom filter of ``words`` words."""

    keys: tuple[str, ...]
    exact: tuple[tuple, ...] | None = None
    rows: DataFrame | None = None
    words: int = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose key may be asked for; it has the key columns in their types."""
        if self.exact is not None:
            for i, key in enumerate(self.keys):
                if isinstance(df.schema[key].dataType, _LITERALS):
                    df = df.filter(q(key).isin(list({row[i] for row in self.exact})))
                    if len(self.keys) == 1:
                        return df
        if self.exact is not None:
            # as many rows as ``exact``
            return df.join(F.broadcast(self.rows), list(self.keys), "left_semi")
        slot, bits = _place(df, self.keys, self.words)
        hit = (slot == q(_SLOT)) & (q(_BITS).bitwiseAND(bits) == bits)
        # at most ``words`` rows of 16 bytes
        return df.join(F.broadcast(self.rows), hit, "left_semi")


def _plain(dtype: T.DataType) -> bool:
    """Whether equal values have equal hashes; strings of a collation need not."""
    if isinstance(dtype, T.StringType):
        return dtype.simpleString() == "string"
    return isinstance(dtype, _HASHED)


def _place(df: DataFrame, keys: tuple[str, ...], words: int) -> tuple[Column, Column]:
    """Word of a key and the four bits it sets there."""
    values = []
    for key in keys:
        floating = isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType))
        values.append(q(key) + F.lit(0).cast(df.schema[key].dataType) if floating else q(key))  # -0.0 is 0.0
    slot = F.pmod(F.xxhash64(*values), F.lit(words))
    draw = F.xxhash64(*values, F.lit(1))
    bits = None
    for n in range(4):
        place = F.shiftrightunsigned(draw, 6 * n).bitwiseAND(F.lit(_WORD - 1)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return slot, bits


def key_filter(asked: DataFrame, keys: list[str], limits: Limits) -> KeyFilter | None:
    """A filter for the keys in ``asked``, or None where none helps.  Runs one to three jobs."""
    keys = tuple(keys)
    if not keys or not all(_plain(asked.schema[k].dataType) for k in keys):
        return None
    asked = asked.select(*[q(k) for k in keys]).filter(all_not_null(keys))
    about = asked.agg(F.approx_count_distinct(F.xxhash64(*[q(k) for k in keys]))).first()[0]
    if about <= limits.exact_keys:
        # the estimate may be off, so the rows read are bounded as well
        found = asked.distinct().limit(2 * limits.exact_keys + 1).collect()
        if len(found) <= 2 * limits.exact_keys:
            exact = tuple(tuple(row) for row in found)
            return KeyFilter(keys, exact, asked.sparkSession.createDataFrame(found, asked.schema))
    if about * _FEWEST_BITS_PER_KEY > limits.filter_words * _WORD:
        return None
    words = 16
    while words < limits.filter_words and words * _WORD < about * _BITS_PER_KEY:
        words *= 2
    slot, bits = _place(asked, keys, words)
    rows = asked.select(slot.alias(_SLOT), bits.alias(_BITS)).groupBy(_SLOT).agg(F.bit_or(_BITS).alias(_BITS))
    # at most ``filter_words`` rows of 16 bytes
    return KeyFilter(keys, None, asked.sparkSession.createDataFrame(rows.toArrow(), rows.schema), words)


def few_points(asked: DataFrame, columns: list[str], limits: Limits) -> DataFrame | None:
    """The distinct values of some columns where they are few, and far fewer than the rows.

    Runs one or two jobs; at most ``2 * few_points`` rows come back.
    """
    columns = list(dict.fromkeys(columns))
    known = asked.filter(all_not_null(columns)).select(*[q(c) for c in columns])
    if not all(_plain(f.dataType) and not isinstance(f.dataType, T.FractionalType) for f in known.schema):
        return None
    seen = known.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*[q(c) for c in columns])).alias("points")).first()
    if seen["points"] > limits.few_points or seen["points"] * _ROWS_PER_POINT > seen["rows"]:
        return None
    # the estimate may be off, so the rows read are bounded as well
    found = known.distinct().limit(2 * limits.few_points + 1).toArrow()
    if found.num_rows > 2 * limits.few_points:
        return None
    return asked.sparkSession.createDataFrame(found, known.schema)
