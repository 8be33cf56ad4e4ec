"""Folders of any file system that Spark reads: make, list, move and delete."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Folders:
    spark: SparkSession

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _fs_mkdirs(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.mkdirs(p)

    def _fs_delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _fs_rename(self, path: str, target: str) -> None:
        fs, p = self._fs(path)
        if not fs.rename(p, self._fs(target)[1]):
            raise OSError(f"could not rename {path}")

    def _fs_exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _fs_list(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
