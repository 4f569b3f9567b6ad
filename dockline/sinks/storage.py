"""Folders of tables and sources, through the file system their path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A path on whatever file system Spark resolves it to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def qualified(self) -> str:
        return self._path.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()).toString().rstrip("/")

    def children(self) -> list[str]:
        """Names of the direct sub-folders."""
        if not self.exists():
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path) if s.isDirectory()]

    def files(self) -> list[str]:
        if not self.exists():
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path) if not s.isDirectory()]

    def holds_files(self) -> bool:
        """Whether a file lies anywhere below; the listing ends at the first one."""
        return self.exists() and self._fs.listFiles(self._path, True).hasNext()

    def remove(self, child: str) -> None:
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(self._path, child), True)

    def create(self, name: str) -> None:
        """Make an empty file that must not be there yet."""
        if not self._fs.createNewFile(self._jvm.org.apache.hadoop.fs.Path(self._path, name)):
            raise OSError(f"{name} is there already")

    def rename(self, old: str, new: str) -> None:
        path = self._jvm.org.apache.hadoop.fs.Path
        if not self._fs.rename(path(self._path, old), path(self._path, new)):
            raise OSError(f"cannot rename {old} to {new}")

    def move(self, child: str, target: str) -> None:
        """Move a sub-folder to a path that is free."""
        path = self._jvm.org.apache.hadoop.fs.Path
        if not self._fs.rename(path(self._path, child), path(target)):
            raise OSError(f"cannot move {child} to {target}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this package has made for its own use."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    Folder(spark, parent).remove(name)


def refuse_overlap(spark: SparkSession, inputs: list[str], target: str) -> None:
    """A load must not read what it replaces: the files would be gone before use."""
    goal = Folder(spark, target).qualified() + "/"
    for path in inputs:
        source = Folder(spark, path.split("*")[0].split("?")[0]).qualified() + "/"
        if source.startswith(goal) or goal.startswith(source):
            raise ValueError(f"input {path} and target {target} overlap")
