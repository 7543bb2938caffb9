"""Folders of a table, through Hadoop's file system so that any storage works."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """One folder and what maintenance needs of it. Lists names; never reads data."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def below(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._fs.exists(self._path(self.path))

    def folders(self) -> list[str]:
        """Names of the folders in it, without hidden ones."""
        if not self.exists():
            return []
        found = [s for s in self._fs.listStatus(self._path(self.path)) if s.isDirectory()]
        names = [s.getPath().getName() for s in found]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    def leaves(self, column: str) -> list[str]:
        """Paths, relative to this folder, of all partition folders of the column below it."""
        found = []
        for name in self.folders():
            if name.startswith(f"{column}="):
                found.append(name)
            else:
                found += [f"{name}/{leaf}" for leaf in self.below(name).leaves(column)]
        return found

    def delete(self) -> bool:
        return self._fs.delete(self._path(self.path), True)

    def move_to(self, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(self.path), self._path(target)):
            raise OSError(f"cannot move {self.path} to {target}")

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self._path(f"{self.path}/{name}"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, name: str) -> str | None:
        path = self._path(f"{self.path}/{name}")
        if not self._fs.exists(path):
            return None
        source = self._fs.open(path)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()
