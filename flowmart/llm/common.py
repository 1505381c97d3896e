"""Small helpers shared by the operators of this subpackage: table access, the shared
folder, stage materialisation, and Arrow batch plumbing."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.operators.commits import remove
from flowmart.session import scratch_path

#: ASCII white space as the word rules define it: space and U+0009 to U+000D.
WS = r"[\x20\x09-\x0D]"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python tasks can
    import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="flowmart-ship-"), "flowmart.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(package)))
    sc.addPyFile(archive)  # the driver serves it; executors fetch their own copy
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only (other letters stay as they are)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """The array of ``[^\\x20\\x09-\\x0D]+`` words; empty for null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS + "+"))


def stage(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends
    there, so a lost executor re-reads files instead of recomputing what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("error")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    made(path)
    return spark.read.schema(df.schema).parquet(path)


_COLLECTORS: list[list[str]] = []


def made(path: str) -> None:
    """Note a folder that an operator has written for itself."""
    for paths in _COLLECTORS:
        paths.append(path)


@contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Add the folders that operators write meanwhile to ``paths``."""
    _COLLECTORS.append(paths)
    try:
        yield
    finally:
        _COLLECTORS.remove(paths)


def release(spark: SparkSession, paths: list[str], needed: DataFrame) -> None:
    """Remove ``paths``, except those that ``needed`` still reads."""
    read = needed.inputFiles()
    for path in list(paths):
        if not any(path in f for f in read):
            remove(spark, path)
            paths.remove(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_rows(fn: Callable[[Iterator[dict]], Iterator[dict]], schema: pa.Schema, rows: int = 2000):
    """Adapt a generator over column dictionaries to ``mapInArrow``: ``fn`` gets an iterator
    of ``{column: pyarrow array}`` per batch and yields row tuples in ``schema`` order."""
    ship(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list] = [[] for _ in schema]
        for row in fn({n: b.column(i) for i, n in enumerate(b.schema.names)} for b in batches):
            for c, v in zip(cols, row):
                c.append(v)
            if len(cols[0]) >= rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
                cols = [[] for _ in schema]
        if cols[0]:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


class Memo(dict):
    """A mapping that computes what it lacks and keeps it: at most ``most`` entries (it starts anew
    when full) with keys of at most ``longest`` characters, so its memory is bounded."""

    def __init__(self, compute: Callable, most: int, longest: int):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value
