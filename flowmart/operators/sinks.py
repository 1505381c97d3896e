"""Sinks: declared range partitions, insert-if-absent, audit (S14-S21); ``write_table`` is in tables.py.

Tables are written as parquet under the shared checkpoint folder (``spark.checkpoint.dir``)
and read back, which cuts lineage (a lost executor recomputes from the written files, not
from staging) and keeps parquet column pruning and filter pushdown for readers.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.operators import commits
from flowmart.operators.keys import dense_keys
from flowmart.operators.tables import write_table

AUDIT_SCHEMA = (
    "batch_id bigint, start_time timestamp, end_time timestamp, status string, "
    "records_processed bigint, aggregation_level string, source_system string, error_message string"
)
SOURCE_SYSTEM = "UNSW-NB15"


def insert_if_absent(new: DataFrame, existing: DataFrame, natural_key: list[str], id_col: str | None = None) -> DataFrame:
    """``INSERT .. ON CONFLICT (nk) DO NOTHING``: ``existing`` plus the rows of ``new`` whose
    key is absent, one per key (the smallest row wins). With ``id_col`` the new members get the
    ids after the largest existing one, in key order (numbered by ranges, see ``keys``)."""
    rest = [c for c in existing.columns if c not in natural_key and c != id_col]
    one = new.groupBy(*natural_key).agg(F.min(F.struct(*rest)).alias("_row")).select(*natural_key, "_row.*")
    fresh = one.join(existing.select(*natural_key), natural_key, "left_anti")
    if id_col is not None:
        last = F.coalesce(existing.agg(F.max(id_col)).scalar(), F.lit(0))
        fresh = dense_keys(fresh.withColumn("_all", F.lit(0)), "_all", natural_key, {id_col: F.lit(True)})
        fresh = fresh.withColumn(id_col, (last + F.col(id_col)).cast(existing.schema[id_col].dataType))
    return existing.unionByName(fresh.select(*existing.columns))


def partition_counts(fact: DataFrame, partition_col: str = "year_month") -> DataFrame:
    """Rows per partition."""
    return fact.groupBy(partition_col).agg(F.count(F.lit(1)).alias("record_count"))


class RangePartitions:
    """A table split by declared ranges of a numeric column. ``ranges``: (name, from, to), half open,
    not overlapping. Rows outside all of them, and rows without a value, go to the partition
    ``default``; readers name an interval and the scan opens only the partitions that it meets."""

    DEFAULT = "default"
    COLUMN = "range_name"

    def __init__(self, column: str, ranges: list[tuple[str, int, int]]):
        ranges = sorted(ranges, key=lambda r: r[1])
        for name, low, high in ranges:
            if low >= high or name == self.DEFAULT:
                raise ValueError(f"not a range: {name} from {low} to {high}")
        for (a, _, high), (b, low, _) in zip(ranges, ranges[1:]):
            if low < high:
                raise ValueError(f"the ranges {a} and {b} overlap")
        if len({r[0] for r in ranges}) < len(ranges):
            raise ValueError("two ranges have the same name")
        self.column, self.ranges = column, ranges

    def route(self) -> Column:
        """The partition of a row: the last range that starts at or before its value, if it reaches that far."""
        if not self.ranges:
            return F.lit(self.DEFAULT)
        c = F.col(self.column)
        bounds = F.array(*[F.struct(F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high"), F.lit(name).alias("name")) for name, low, high in self.ranges])
        hit = F.filter(bounds, lambda r: (r["low"] <= c) & (c < r["high"]))
        return F.coalesce(F.try_element_at(hit, F.lit(1))["name"], F.lit(self.DEFAULT))

    def write(self, df: DataFrame, path: str) -> DataFrame:
        return write_table(df.withColumn(self.COLUMN, self.route()), path, [self.COLUMN])

    def met(self, low: int, high: int) -> list[str]:
        """The partitions that can hold values from ``low`` up to but not including ``high``."""
        inside = [(name, max(a, low), min(b, high)) for name, a, b in self.ranges if a < high and low < b]
        covered = sum(b - a for _, a, b in inside)  # the ranges don't overlap
        return [name for name, _, _ in inside] + [self.DEFAULT] * (covered < high - low)

    def between(self, table: DataFrame, low: int, high: int) -> DataFrame:
        """The rows of a written table with ``low <= value < high``; other partitions are not opened."""
        c = F.col(self.column)
        return table.filter(F.col(self.COLUMN).isin(self.met(low, high)) & (c >= low) & (c < high))

    def counts(self, table: DataFrame) -> DataFrame:
        """Rows per partition, declared ones without rows included."""
        names = [*(r[0] for r in self.ranges), self.DEFAULT]
        declared = table.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias(self.COLUMN))
        return declared.join(partition_counts(table, self.COLUMN), self.COLUMN, "left").select(self.COLUMN, F.coalesce("record_count", F.lit(0)).alias("record_count"))


class Audit:
    """Batch audit rows. A batch leaves a STARTED row before its step runs, and a COMPLETED or
    FAILED row (with the whole error message) afterwards; ``table`` shows each batch's latest
    state. Rows are appended to a small parquet table under the shared folder.

    A batch id is claimed before it is used: a file with that number is put if it is absent, so two
    drivers never take one id. The claim names its owner and a lease; ``fail_orphans`` turns
    batches that are still STARTED after their owner's lease into FAILED ones. A batch that does
    finish later has the last word.
    """

    def __init__(self, spark: SparkSession, path: str, lease: _dt.timedelta = _dt.timedelta(hours=24)):
        self.spark = spark
        self.path = path
        self.lease = lease
        self.claims = f"{path}_claims"
        self.owner = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"

    def _append(self, row: tuple) -> None:
        # Built from JVM literals (no Python rows to ship to executors).
        names = [f.split()[0] for f in AUDIT_SCHEMA.split(", ")]
        types = [f.split()[1] for f in AUDIT_SCHEMA.split(", ")]
        cols = [F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)]
        self.spark.range(1).select(*cols).write.mode("append").parquet(self.path)

    def events(self) -> DataFrame:
        """Every row ever written."""
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path)

    def _claimed(self) -> list[int]:
        return [int(n) for n in commits.children(self.spark, self.claims) if n.isdigit()]

    def _claim(self, now: _dt.datetime, level: str) -> int:
        text = json.dumps({"owner": self.owner, "level": level, "lease_until": (now + self.lease).isoformat()})
        batch_id = max(self._claimed(), default=0) + 1
        while not commits.put_if_absent(self.spark, f"{self.claims}/{batch_id:012d}", text):
            batch_id += 1  # another driver has it
        return batch_id

    def start(self, level: str) -> tuple[int, _dt.datetime]:
        now = _now()
        batch_id = self._claim(now, level)
        self._append((batch_id, now, None, "STARTED", None, level, SOURCE_SYSTEM, None))
        return batch_id, now

    def finish(self, batch_id: int, level: str, started: _dt.datetime, records: int | None,
               status: str = "COMPLETED", error: str | None = None) -> None:
        self._append((batch_id, started, _now(), status, records, level, SOURCE_SYSTEM, error))

    def fail_orphans(self, now: _dt.datetime | None = None) -> list[int]:
        """Claimed batches without an end whose lease is over (their driver is gone) become FAILED, each
        by exactly one of the drivers that find it; returns those that this one has failed."""
        now = now or _now()
        claimed = self._claimed()
        if not claimed:
            return []
        ended = set()
        if commits.exists(self.spark, self.path):
            ended = {r[0] for r in self.events().filter("end_time is not null").select("batch_id").distinct().collect()}  # one number per batch
        out = []
        for batch_id in sorted(set(claimed) - ended):
            path = f"{self.claims}/{batch_id:012d}"
            claim = json.loads(commits.read_text(self.spark, path))
            over = _dt.datetime.fromisoformat(claim["lease_until"]) < now
            if over and commits.put_if_absent(self.spark, f"{path}.orphan", self.owner):
                self._append((batch_id, None, now, "FAILED", None, claim["level"], SOURCE_SYSTEM, f"the driver {claim['owner']} ended without a result"))
                out.append(batch_id)
        return out

    def run(self, level: str, step):
        """Run ``step(batch_id) -> records`` inside an audited batch."""
        return self.run_all([(level, step)])[0]

    def run_all(self, steps: list) -> list[int]:
        """Run (level, step) pairs in order, all STARTED first. If one fails, the finished ones stay
        COMPLETED, it and those still STARTED become FAILED, and the error is raised."""
        batches = [(level, step, *self.start(level)) for level, step in steps]
        for i, (level, step, batch_id, started) in enumerate(batches):
            try:
                records = step(batch_id)
            except Exception as exc:  # noqa: BLE001 - re-raised after the FAILED rows are stored
                for late, _, late_id, late_started in batches[i:]:
                    self.finish(late_id, late, late_started, None, "FAILED", str(exc))
                raise
            self.finish(batch_id, level, started, records)
        return [b[2] for b in batches]

    def table(self) -> DataFrame:
        """One row per batch: its last state, or STARTED while there is none."""
        names = [f.split()[0] for f in AUDIT_SCHEMA.split(", ")]
        rest = F.struct(*names[1:])
        latest = self.events().groupBy("batch_id").agg(F.max_by(rest, F.coalesce("end_time", F.lit(_dt.datetime(1970, 1, 1)))).alias("r"))
        return latest.select("batch_id", "r.*")


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def latest_batch(audit: DataFrame) -> DataFrame:
    """The most recent batch (highest id)."""
    return audit.orderBy(F.col("batch_id").desc()).limit(1)
