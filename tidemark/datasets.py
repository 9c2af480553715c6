"""Retrieval results and the datasets saved from them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import SavedDatasetNotFound
from tidemark.functions.columns import q
from tidemark.functions.times import utc_text
from tidemark.operators.quality import Expectation, Profiler, validate
from tidemark.session import shared_folder
from tidemark.sources.batch import in_time_range


@dataclass(frozen=True)
class Reference:
    """What a dataset is validated against."""

    dataset: str
    expectations: tuple[Expectation, ...]


@dataclass(frozen=True)
class Retrieval:
    """A lazy result: the DataFrame and what it was made from."""

    df: DataFrame
    features: tuple[str, ...]
    join_keys: tuple[str, ...]
    event_timestamp: str
    full_feature_names: bool = False

    def to_spark_df(self) -> DataFrame:
        return self.df

    def to_df(self, validation_reference: Reference | None = None) -> pd.DataFrame:
        """The rows as pandas, checked first if a reference is given."""
        return self.validated(validation_reference).toPandas()

    def to_arrow(self, validation_reference: Reference | None = None) -> pa.Table:
        return self.validated(validation_reference).toArrow()

    def to_batches(self) -> Iterator[pa.RecordBatch]:
        """The rows as Arrow batches, one partition at a time."""

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(batch)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch"])

        for row in self.df.mapInArrow(packed, "batch binary").toLocalIterator(prefetchPartitions=True):
            yield from pa.ipc.open_stream(row["batch"])

    def to_rows(self) -> Iterator[Row]:
        """The rows one partition at a time, for results too large to collect."""
        return self.df.toLocalIterator(prefetchPartitions=True)

    def validated(self, reference: Reference | None) -> DataFrame:
        """The rows, checked first if a reference is given; the joins run once for both.

        The checked rows are kept in a table in the shared folder while they are handed on.
        """
        if reference is None:
            return self.df
        spark = self.df.sparkSession
        path = shared_folder(spark, "validated")
        self.df.write.parquet(path)
        rows = spark.read.schema(self.df.schema).parquet(path)
        validate(rows, list(reference.expectations))
        return rows

    def validate(self, reference: Reference | None) -> None:
        """Check the rows on the executors; raises if an expectation is not met."""
        if reference is not None:
            validate(self.df, list(reference.expectations))

    def persist(self, storage: FileStorage | TableStorage) -> None:
        storage.write(self.df)

    def explain(self) -> None:
        """Print the query plan with its size estimates; nothing runs."""
        self.df.explain("cost")

    def query_text(self) -> str:
        """The logical and physical plans as text; nothing runs."""
        return self.df._jdf.queryExecution().toString()


@dataclass(frozen=True)
class FileStorage:
    """A folder of files."""

    path: str
    file_format: str = "parquet"
    mode: str = "overwrite"

    def write(self, df: DataFrame) -> None:
        df.write.mode(self.mode).format(self.file_format).save(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.file_format).load(self.path)


@dataclass(frozen=True)
class TableStorage:
    """A table of the session's catalog; with a ``path`` its files lie there."""

    table: str
    mode: str = "overwrite"
    path: str | None = None

    def write(self, df: DataFrame) -> None:
        writer = df.write.mode(self.mode)
        if self.path:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.table)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


@dataclass(frozen=True)
class SavedDataset:
    """A stored retrieval with its metadata."""

    name: str
    storage: FileStorage | TableStorage
    features: tuple[str, ...]
    join_keys: tuple[str, ...]
    event_timestamp: str
    full_feature_names: bool
    min_event_timestamp: datetime | None
    max_event_timestamp: datetime | None
    tags: dict[str, str] = field(default_factory=dict)
    feature_service: str | None = None
    expectations: tuple[Expectation, ...] = ()

    def to_spark_df(self, spark: SparkSession) -> DataFrame:
        """The stored rows, from the earliest event time to one second past the latest."""
        df = self.storage.read(spark)
        if self.min_event_timestamp is None:
            return df
        end = self.max_event_timestamp + timedelta(seconds=1)
        return in_time_range(df, self.event_timestamp, self.min_event_timestamp, end)


class SavedDatasets:
    """Saved datasets below one folder: data plus a small JSON record each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def save(
        self,
        retrieval: Retrieval,
        name: str,
        storage: FileStorage | TableStorage | None = None,
        tags: dict[str, str] | None = None,
        feature_service: str | None = None,
    ) -> SavedDataset:
        """Write a retrieval; the same name replaces the earlier dataset.

        The span of event times is observed while the rows are written, so it takes no
        extra job.  Without a storage the data goes to a new folder, so that a dataset
        may be derived from the one it replaces.
        """
        storage = storage or FileStorage(f"{self.root}/{name}/data-{uuid.uuid4().hex}")
        ts = q(retrieval.event_timestamp)
        dtype = retrieval.df.schema[retrieval.event_timestamp].dataType
        span = Observation()
        observed = retrieval.df.observe(
            span,
            utc_text(F.min(ts), dtype).alias("lo"),
            utc_text(F.max(ts), dtype).alias("hi"),
        )
        storage.write(observed)
        lo, hi = (span.get.get(k) for k in ("lo", "hi"))
        dataset = SavedDataset(
            name=name,
            storage=storage,
            features=retrieval.features,
            join_keys=retrieval.join_keys,
            event_timestamp=retrieval.event_timestamp,
            full_feature_names=retrieval.full_feature_names,
            min_event_timestamp=None if lo is None else datetime.fromisoformat(lo),
            max_event_timestamp=None if hi is None else datetime.fromisoformat(hi),
            tags=tags or {},
            feature_service=feature_service,
        )
        self._write_record(dataset)
        return dataset

    def get(self, name: str) -> SavedDataset:
        try:
            row = self.spark.read.schema("record string").json(f"{self.root}/{name}/record").first()
        except AnalysisException as error:
            raise SavedDatasetNotFound(f"no saved dataset {name!r}") from error
        return _from_record(json.loads(row["record"]))

    def as_reference(self, dataset: SavedDataset, profiler: Profiler | None = None) -> Reference:
        """Expectations of a dataset.

        With a profiler they are computed once and stored with the dataset; without one
        the stored ones are used.
        """
        if profiler is not None:
            found = tuple(profiler(dataset.to_spark_df(self.spark)))
            self._write_record(_replace(dataset, expectations=found))
            return Reference(dataset.name, found)
        return Reference(dataset.name, self.get(dataset.name).expectations)

    def _write_record(self, dataset: SavedDataset) -> None:
        text = json.dumps(_to_record(dataset))
        self.spark.createDataFrame([(text,)], "record string").coalesce(1).write.mode(
            "overwrite"
        ).json(f"{self.root}/{dataset.name}/record")


def _replace(dataset: SavedDataset, **changes) -> SavedDataset:
    return SavedDataset(**{**dataset.__dict__, **changes})


def _to_record(d: SavedDataset) -> dict:
    files = isinstance(d.storage, FileStorage)
    return {
        "name": d.name,
        "storage": {"kind": "files" if files else "table", **d.storage.__dict__},
        "features": list(d.features),
        "join_keys": list(d.join_keys),
        "event_timestamp": d.event_timestamp,
        "full_feature_names": d.full_feature_names,
        "min": d.min_event_timestamp and d.min_event_timestamp.isoformat(),
        "max": d.max_event_timestamp and d.max_event_timestamp.isoformat(),
        "tags": d.tags,
        "feature_service": d.feature_service,
        "expectations": [[e.check, e.column, e.params] for e in d.expectations],
    }


def _from_record(r: dict) -> SavedDataset:
    storage = dict(r["storage"])
    kind = FileStorage if storage.pop("kind") == "files" else TableStorage
    return SavedDataset(
        name=r["name"],
        storage=kind(**storage),
        features=tuple(r["features"]),
        join_keys=tuple(r["join_keys"]),
        event_timestamp=r["event_timestamp"],
        full_feature_names=r["full_feature_names"],
        min_event_timestamp=r["min"] and datetime.fromisoformat(r["min"]),
        max_event_timestamp=r["max"] and datetime.fromisoformat(r["max"]),
        tags=r["tags"],
        feature_service=r["feature_service"],
        expectations=tuple(Expectation(*e) for e in r["expectations"]),
    )
