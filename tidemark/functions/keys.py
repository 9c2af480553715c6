"""Entity keys as single columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import q


def row_id(*cols: Column) -> Column:
    """Readable id of a row.  The separator keeps ("1", "23") and ("12", "3") apart.

    Joins use the key columns themselves; this is for labelling rows.
    """

    def escaped(c: Column) -> Column:
        text = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit(""))

    return F.concat_ws("|", *[escaped(c) for c in cols])


def entity_key(df: DataFrame, keys: list[str]) -> Column:
    """Canonical text of an entity key: sorted names, type tags, lengths and values.

    The same entity gives the same text however the key columns are ordered.
    """
    parts: list[Column] = []
    for name in sorted(keys):
        text = q(name).cast("string")
        tag = df.schema[name].dataType.simpleString()
        parts.append(
            F.concat(
                F.lit(f"{name}:{tag}:"),
                F.length(text).cast("string"),
                F.lit(":"),
                text,
            )
        )
    return F.concat_ws(";", *parts)


def entity_hash(keys: list[str]) -> Column:
    """64-bit hash of an entity key, for use as a compact row id."""
    return F.xxhash64(*[q(k) for k in sorted(keys)])
