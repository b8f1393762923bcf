"""Folders of the shared store, by Hadoop's file system (the one Spark itself reads and writes with)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def names(self, path: str) -> list[str]:
        """Names in a folder, none if it is not there."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def move(self, old: str, new: str) -> None:
        """A folder takes its final place in one step (on stores whose rename is one)."""
        fs, p = self._at(old)
        target = self._path(new)
        fs.mkdirs(target.getParent())
        if not fs.rename(p, target):
            raise OSError(f"cannot move {old} to {new}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
