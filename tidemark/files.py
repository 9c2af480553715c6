"""Small files in any file system Spark reaches, such as log records; no job runs."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SmallFiles:
    """Listing, reading and adding small files."""

    def __init__(self, spark: SparkSession):
        context = spark.sparkContext
        self._jvm = context._jvm
        self._conf = context._jsc.hadoopConfiguration()

    def _open(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        system, place = self._open(folder)
        if not system.exists(place):
            return []
        return sorted(s.getPath().getName() for s in system.listStatus(place))

    def read(self, path: str) -> str:
        system, place = self._open(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def add(self, folder: str, name: str, text: str) -> None:
        """A new file, seen by others only when it is whole.  Its name must be unused."""
        system, place = self._open(f"{folder}/{name}")
        _, draft = self._open(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = system.create(draft, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if not system.rename(draft, place):
            raise OSError(f"cannot write {folder}/{name}")

    def size(self, folder: str) -> int:
        """Bytes of all files below a folder."""
        system, place = self._open(folder)
        return system.getContentSummary(place).getLength()
