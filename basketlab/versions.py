"""Tables that are replaced as a whole or not at all.

A versioned table is a folder with one data folder for each version and a numbered log
of small manifests, one for each version.  A writer fills a data folder that nobody
reads yet and then moves its manifest into the log; that single rename, which fails if
the number is taken, makes the version the current one.  Readers follow the last
manifest.  A job that dies before the rename leaves the old version in force and at
worst an unreferenced folder, which the next write removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LOG = "_versions"
DATA = "data-"
KEPT = 2


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    kind: str
    notes: dict


class _Files:
    """The few calls that are needed of the file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        if not self._fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        stream = self._fs.create(self.path(name), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def move(self, name: str, to: str) -> bool:
        return not self._fs.exists(self.path(to)) and self._fs.rename(self.path(name), self.path(to))

    def remove(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


def _numbers(files: _Files, path: str) -> list[int]:
    names = files.names(f"{path}/{LOG}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _manifest(files: _Files, path: str, number: int) -> dict:
    return json.loads(files.read(f"{path}/{LOG}/{number:09d}.json"))


def current(spark: SparkSession, path: str) -> Version | None:
    """The version in force, None where no complete one was ever written."""
    path = path.rstrip("/")
    files = _Files(spark, path)
    numbers = _numbers(files, path)
    if not numbers:
        return None
    found = _manifest(files, path, numbers[-1])
    return Version(numbers[-1], f"{path}/{found['folder']}", found["kind"], found["notes"])


def replace(
    spark: SparkSession, path: str, write_to: Callable[[str], None], kind: str = "parquet", notes: dict | None = None
) -> Version:
    """Fill a new data folder with ``write_to(folder)`` and make it the current version.

    The version before stays for readers that hold it; older ones and the remains of
    broken writes go.  Of two writers at a time the later to finish gets an error.
    """
    path = path.rstrip("/")
    files = _Files(spark, path)
    before = _numbers(files, path)
    number = before[-1] + 1 if before else 1
    folder = f"{DATA}{number:09d}-{uuid.uuid4().hex}"
    write_to(f"{path}/{folder}")
    draft = f"{path}/{LOG}/.{uuid.uuid4().hex}"
    files.put(draft, json.dumps({"folder": folder, "kind": kind, "notes": notes or {}}))
    if not files.move(draft, f"{path}/{LOG}/{number:09d}.json"):
        files.remove(draft)
        files.remove(f"{path}/{folder}")
        raise RuntimeError(f"version {number} of {path} was written by another job meanwhile")
    _tidy(files, path, number)
    return Version(number, f"{path}/{folder}", kind, notes or {})


def _tidy(files: _Files, path: str, number: int) -> None:
    """Drop manifests and data folders older than the kept versions, and folders of broken writes."""
    for n in _numbers(files, path):
        if n <= number - KEPT:
            files.remove(f"{path}/{LOG}/{n:09d}.json")
    kept = {_manifest(files, path, n)["folder"] for n in _numbers(files, path)}
    for name in files.names(path):
        if name.startswith(DATA) and name not in kept and int(name[len(DATA) :].split("-")[0]) <= number:
            files.remove(f"{path}/{name}")


def write(df: DataFrame, path: str, kind: str = "parquet") -> Version:
    """Replace the table at ``path`` by ``df``."""
    return replace(df.sparkSession, path, lambda folder: df.write.format(kind).save(folder), kind)
