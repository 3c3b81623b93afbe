"""State of runs: numbered versions, each committed by one rename that fails if the version is there, so that no crash loses it and no run overwrites another."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Versions that stay.
KEPT = 10


class StateConflict(RuntimeError):
    """Another run has committed since this one read the state."""


class StateFile:
    """A state at a path: the versions are files in ``<path>.versions``; the path itself is read if there are none (a state from before)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder, self.version = spark, path, f"{path}.versions", 0
        self.jvm = spark._jvm
        self.fs = self.at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def versions(self) -> list[int]:
        if not self.fs.exists(self.at(self.folder)):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.at(self.folder))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def text(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read(self) -> dict:
        """The last version that is whole (a broken one is passed over), else the plain file, else nothing; the version read is remembered."""
        known = self.versions()
        self.version = known[-1] if known else 0
        for path in [*(f"{self.folder}/{v:012d}.json" for v in reversed(known)), self.path]:
            if self.fs.exists(self.at(path)) and self.fs.getFileStatus(self.at(path)).isFile():
                try:
                    return json.loads(self.text(path))
                except ValueError:
                    continue
        return {}

    def commit(self, state: dict) -> int:
        """Makes the state the version after the one read. Raises StateConflict, and changes nothing, if that is there already."""
        after, beside = self.version + 1, self.at(f"{self.folder}/.{uuid.uuid4().hex}.new")
        target = self.at(f"{self.folder}/{after:012d}.json")
        out = self.fs.create(beside, False)
        out.write(bytearray(json.dumps(state, indent=2, sort_keys=True, ensure_ascii=False, default=str).encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self.context().rename(self.fs.makeQualified(beside), self.fs.makeQualified(target), none)
        except Py4JJavaError as e:
            self.fs.delete(beside, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise StateConflict(f"{self.path}: version {after} is there already") from None
            raise
        self.version = after
        for old in self.versions()[:-KEPT]:
            self.fs.delete(self.at(f"{self.folder}/{old:012d}.json"), False)
        return after

    def context(self):
        return self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())

    def update(self, change: Callable[[dict], dict], tries: int = 20) -> dict:
        """Reads the latest state, changes it and commits; begins again if another run was faster, so that nobody's change is lost."""
        for _ in range(tries):
            state = change(self.read())
            try:
                self.commit(state)
                return state
            except StateConflict:
                continue
        raise StateConflict(f"{self.path}: {tries} tries")
