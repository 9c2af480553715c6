"""The last feature row per key at a moment, kept so that later training sets read only what came after.

A training set whose rows all lie at or after the cut needs, of everything up to the cut,
one row per key and view: the latest.  These are stored once; the sources are then read
from the cut on.  A carry can be made from an earlier one and the rows in between.  Source
rows that arrive after the carry was made, with event times before its cut, are not seen.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.errors import TidemarkError
from tidemark.files import SmallFiles


@dataclass(frozen=True)
class Carry:
    """Tables of the latest rows up to ``cut`` (included), by view; times are zone-less UTC."""

    name: str
    cut: str
    folders: dict[str, str]
    schemas: dict[str, str]

    @property
    def at(self) -> datetime:
        return datetime.fromisoformat(self.cut)

    def rows(self, spark: SparkSession, view: str) -> DataFrame:
        if view not in self.folders:
            raise TidemarkError(f"carry {self.name!r} holds nothing of view {view!r}")
        schema = T.StructType.fromJson(json.loads(self.schemas[view]))
        return spark.read.schema(schema).parquet(self.folders[view])


class Carries:
    """Carries below one folder; each is whole once its file of names is there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = SmallFiles(spark)

    def save(self, name: str, cut: datetime, tables: dict[str, DataFrame]) -> Carry:
        if f"{name}.json" in self.files.names(self.root):
            raise TidemarkError(f"there is a carry {name!r} already")
        folders, schemas = {}, {}
        for view, rows in tables.items():
            folders[view] = f"{self.root}/{view}-{uuid.uuid4().hex}"
            schemas[view] = rows.schema.json()
            rows.write.parquet(folders[view])
        carry = Carry(name, cut.isoformat(), folders, schemas)
        self.files.add(self.root, f"{name}.json", json.dumps(asdict(carry)))
        return carry

    def get(self, name: str) -> Carry:
        if f"{name}.json" not in self.files.names(self.root):
            raise TidemarkError(f"there is no carry {name!r}")
        return Carry(**json.loads(self.files.read(f"{self.root}/{name}.json")))
