"""The few file operations that Spark has no DataFrame for."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import SparkSession


class Files:
    """Steps with single files, on the file system that a path names."""

    def __init__(self, spark: SparkSession) -> None:
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple[Any, Any]:
        place = self.hadoop.Path(path)
        return place.getFileSystem(self.conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def _listed(self, path: str) -> list[Any]:
        system, place = self._at(path)
        return list(system.listStatus(place)) if system.exists(place) else []

    def folders(self, path: str, hidden: str | None = None) -> list[str]:
        """Names of the folders in a folder, or of its hidden ones that begin with ``hidden``."""
        names = [s.getPath().getName() for s in self._listed(path) if s.isDirectory()]
        return sorted(n for n in names if (n[0] not in "._" if hidden is None else n.startswith(hidden)))

    def names(self, path: str, start: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._listed(path) if s.isFile() and s.getPath().getName().startswith(start))

    def touch(self, path: str) -> None:
        system, place = self._at(path)
        system.create(place, True).close()

    def remove(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def move(self, path: str, target: str) -> None:
        system, place = self._at(path)
        goal = self.hadoop.Path(target)
        if not system.exists(goal.getParent()):
            system.mkdirs(goal.getParent())
        if not system.rename(place, goal):
            raise RuntimeError(f"{path} could not be moved to {target}")

    def renew(self, path: str) -> None:
        """Make now the time of a file, where the file system keeps times."""
        system, place = self._at(path)
        system.setTimes(place, int(time.time() * 1000), -1)

    def write(self, path: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        system, place = self._at(f"{path}.new")
        out = system.create(place, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(f"{path}.new", path)

    def text(self, path: str) -> str:
        system, place = self._at(path)
        source = system.open(place)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()
