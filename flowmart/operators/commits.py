"""Small files in the shared folder that decide things: claims and numbered commits.

Both rest on ``put_if_absent``: a file appears with its whole content or not at all, and of several
writers exactly one succeeds. On a local file system that is a hard link to a finished
temporary file, elsewhere a rename that fails if the target exists (HDFS and stores whose
renames are atomic).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, without hidden ones; none if there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith((".", "_")))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``; False if it is there already."""
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(target) and fs.rename(draft, target)
        local = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
        try:
            spark._jvm.java.nio.file.Files.createLink(local(fs.makeQualified(target)), local(fs.makeQualified(draft)))
            return True
        except Py4JJavaError as exc:
            if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
                return False
            raise
    finally:
        fs.delete(draft, False)


class Commits:
    """A state (JSON) with numbered versions in a folder: readers take the latest, a writer's version
    stands only if no other one came first."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, version: int) -> str:
        return f"{self.folder}/{version:012d}.json"

    def latest(self) -> tuple[int, dict]:
        """(version, state); (0, {}) before the first commit."""
        versions = [int(n.split(".")[0]) for n in children(self.spark, self.folder) if n.endswith(".json")]
        if not versions:
            return 0, {}
        return max(versions), json.loads(read_text(self.spark, self._path(max(versions))))

    def commit(self, after: int, state: dict) -> bool:
        """Make ``state`` the version after ``after``; False if that version exists."""
        return put_if_absent(self.spark, self._path(after + 1), json.dumps(state, sort_keys=True))

    def update(self, change: Callable[[dict], dict]) -> dict:
        """Apply ``change`` to the latest state, again if another writer came first."""
        while True:
            version, state = self.latest()
            new = change(state)
            if self.commit(version, new):
                return new
