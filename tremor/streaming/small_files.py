"""Small files in whatever store the cluster shares, by Hadoop's file system interface."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SmallFiles:
    """Texts of a few lines that appear whole or not at all: each is written aside and renamed."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._settings = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._settings), place

    def exists(self, path: str) -> bool:
        store, place = self._at(path)
        return store.exists(place)

    def write(self, path: str, text: str) -> None:
        """Writes the text unless the file is there already."""
        if self.exists(path):
            return
        store, aside = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        out = store.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not store.rename(aside, self._at(path)[1]) and not self.exists(path):
            raise OSError(f"cannot write {path}")

    def read(self, path: str) -> str:
        store, place = self._at(path)
        stream = store.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Names of the folder's whole files; none if there is no such folder."""
        store, place = self._at(folder)
        if not store.exists(place):
            return []
        found = [status.getPath().getName() for status in store.listStatus(place)]
        return sorted(name for name in found if not name.endswith(".tmp"))
