"""Adding columns computed from batches of text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

TEXT = "__text"


def annotate(
    df: DataFrame,
    text: str,
    make: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
    fields: Sequence[StructField],
    keep: Sequence[str],
) -> DataFrame:
    """The ``keep`` columns of every row with new columns; row order and count stay.

    ``make`` runs once per task and returns the function from a batch of texts to the new
    columns.  A column of ``keep`` named like a new one gives way to it.
    """
    made = {f.name for f in fields}
    kept = [c for c in keep if c not in made]
    schema = StructType([df.schema[c] for c in kept] + list(fields))
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            new = work(batch.column(len(kept)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *new], names=names)

    return df.select(*kept, F.col(text).cast("string").alias(TEXT)).mapInArrow(run, schema)


def kept_rows(
    docs: DataFrame, annotated: Callable[[DataFrame, str, tuple[str, ...]], DataFrame], condition: str, text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that meet a condition on columns computed from their text.

    ``annotated`` gets the rows under neutral names, with the name of the text and of all
    columns to keep, so that no column of ``docs`` can clash with a computed one.
    """
    names = [f"__column{i}" for i in range(len(docs.columns))]
    found = annotated(docs.toDF(*names), names[docs.columns.index(text)], tuple(names))
    return found.filter(condition).select(*names).toDF(*docs.columns)
