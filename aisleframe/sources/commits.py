"""A log of numbered commits in a folder, for tables that are replaced while others read or replace them.

Each commit is one small file that is created complete or not at all, and never twice. Writers work optimistically: they
write their data to a folder of their own, take the number behind the latest one, and if another writer was faster take the next.
Readers list the log. A writer that dies leaves data that no commit names, and changes nothing.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_commits"
DIGITS = 20


class CommitConflict(RuntimeError):
    """Another writer committed since the version that a change was made for."""


class CommitLog:
    """The commits below a folder on any Hadoop file system whose rename without overwriting is atomic, or a local disk."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.folder = folder.rstrip("/")
        self._log = self._path(f"{self.folder}/{LOG}")
        self._fs = self._log.getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _file(self, version: int):
        return self._path(f"{self.folder}/{LOG}/{version:0{DIGITS}d}.json")

    def versions(self) -> list[int]:
        if not self._fs.exists(self._log):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(self._log))
        return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())

    def latest(self) -> int:
        """The highest version, -1 where there is none."""
        return max(self.versions(), default=-1)

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._file(version))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def add(self, entry: dict, after: int | None = None) -> int:
        """Commits an entry and returns its version: the next free one, or exactly the one behind ``after``."""
        draft = self._path(f"{self.folder}/{LOG}/.{uuid.uuid4().hex}.draft")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        try:
            version = (self.latest() if after is None else after) + 1
            while not self._claim(draft, self._file(version)):
                if after is not None:
                    raise CommitConflict(f"version {version} of {self.folder} is already there")
                version += 1
            return version
        finally:
            self._fs.delete(draft, False)

    def _claim(self, draft, target) -> bool:
        """Gives the finished draft its number; False if the number is taken."""
        try:
            if self._fs.getScheme() == "file":
                files = self._jvm.java.nio.file.Files
                files.createLink(*(self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)))
            else:
                kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
                never_overwrite = self._gateway.new_array(kind, 1)
                never_overwrite[0] = kind.NONE
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._log.toUri(), self._conf)
                context.rename(draft, target, never_overwrite)
            return True
        except Py4JJavaError as failed:
            if "FileAlreadyExistsException" in failed.java_exception.getClass().getName():
                return False
            raise


def swap_folder(spark: SparkSession, new: str, dest: str) -> None:
    """Puts a finished folder in the place of another. If that fails the old one is put back; it is deleted at the end."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    target, aside = path(dest), path(f"{dest}.replaced-{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"{dest} cannot be replaced")
    try:
        if not fs.rename(path(new), target):
            raise OSError(f"{new} cannot be moved to {dest}")
    except BaseException:
        if had:
            fs.rename(aside, target)
        raise
    if had:
        fs.delete(aside, True)
