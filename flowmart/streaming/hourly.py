"""Incremental hourly rollup of arriving connections (Structured Streaming).

Source: ``events`` parquet files (a table folder, a single file, or a folder to which files are
added), mapped to connection records with the same column expressions as the batch path and
filtered by the staging rules. Event time is interleaved over months, so no watermark could
bound lateness without losing rows. Instead the stream keeps no state at all: each micro-batch
is aggregated to additive partials (counts and sums per hour, service, protocol, attack
category) that replace the folder of its batch number - a retried batch overwrites itself -
and ``rollup`` adds the partials up. The result is exact for any file layout, any arrival
order and any number of batches.

``compact`` merges the partials of finished batches into one folder. A commit names that folder and
the last batch in it; readers take it and the batches after. The switch is atomic, a compaction
that dies before it has changed nothing, and a retry of a merged batch writes a folder that no
reader looks at any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowmart.functions.classify import is_attack_category
from flowmart.operators import commits
from flowmart.operators.quality import valid_rows
from flowmart.sources.fixture import raw_connections
from flowmart.sources.schema import conform

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
KEYS = ["window_start", "service_name", "protocol_name", "attack_category"]
MEASURES = ["total_connections", "normal_connections", "attack_connections", "total_bytes", "total_packets", "duration_ms_sum"]
SINK_SCHEMA = "window_start bigint, service_name string, protocol_name string, attack_category string, " + ", ".join(
    f"{m} bigint" for m in MEASURES
)


def connection_stream(spark: SparkSession, events_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A file stream watches a folder: a table that is one file is that file in its folder.
    path = spark._jvm.org.apache.hadoop.fs.Path(events_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile():
        events = reader.option("pathGlobFilter", path.getName()).parquet(path.getParent().toString())
    else:
        events = reader.parquet(events_path)
    return valid_rows(conform(raw_connections(events)))


def partials(rows: DataFrame) -> DataFrame:
    """Additive counts and sums per hour and keys."""
    c = F.col
    attack = is_attack_category(c("attack_cat"))
    rows = rows.filter(c("stime").isNotNull()).select(
        (c("stime") - F.pmod(c("stime"), F.lit(3600))).alias("window_start"),
        F.coalesce(c("service"), F.lit("UNKNOWN")).alias("service_name"),
        F.coalesce(c("proto"), F.lit("UNKNOWN")).alias("protocol_name"),
        F.when(attack, c("attack_cat")).otherwise(F.lit("NORMAL")).alias("attack_category"),
        attack.alias("is_attack"),
        (c("sbytes") + c("dbytes")).alias("bytes"),
        (c("spkts").cast("bigint") + c("dpkts").cast("bigint")).alias("packets"),
        (c("dur").try_cast("decimal(10,3)") * 1000).cast("bigint").alias("duration_ms"),
    )
    return rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.count(F.when(~c("is_attack"), 1)).alias("normal_connections"),
        F.count(F.when(c("is_attack"), 1)).alias("attack_connections"),
        F.sum("bytes").alias("total_bytes"),
        F.sum("packets").alias("total_packets"),
        F.sum("duration_ms").alias("duration_ms_sum"),
    )


def start(spark: SparkSession, events_path: str, sink_dir: str, checkpoint_dir: str, available_now: bool = True,
          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the rollup; batch N writes its partials to ``sink_dir/batch_id=N``."""

    def write_batch(df: DataFrame, batch_id: int) -> None:
        partials(df).write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")

    stream = connection_stream(spark, events_path, max_files_per_trigger)
    writer = stream.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(write_batch)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def _batches(spark: SparkSession, sink_dir: str) -> list[int]:
    """The numbers of the batches whose folder is complete."""
    names = [n for n in commits.children(spark, sink_dir) if n.startswith("batch_id=")]
    return sorted(int(n.split("=")[1]) for n in names if commits.exists(spark, f"{sink_dir}/{n}/_SUCCESS"))


def _partials_since(spark: SparkSession, sink_dir: str, state: dict, upto: int | None = None) -> DataFrame:
    """The merged partials and those of the batches after them (up to ``upto``)."""
    later = [b for b in _batches(spark, sink_dir) if b > state.get("upto", -1) and (upto is None or b <= upto)]
    folders = [f"{sink_dir}/{f}" for f in [*_merged(state), *(f"batch_id={b}" for b in later)]]
    return spark.read.schema(SINK_SCHEMA).parquet(*(folders or [sink_dir]))


def _merged(state: dict) -> list[str]:
    return [state["merged"]] if state else []


def _sums(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def compact(spark: SparkSession, sink_dir: str, keep: int = 1) -> int:
    """Merge all complete batches but the last ``keep`` (the last one may still be retried while the stream
    runs); returns the last merged batch, -1 if there is none. Their folders and the merged folder
    before go one compaction later, so that a query that was planned on them still finds its files."""
    log = commits.Commits(spark, f"{sink_dir}/_merged")
    version, state = log.latest()
    for folder in state.get("retired", []):
        commits.remove(spark, f"{sink_dir}/{folder}")
    done = [b for b in _batches(spark, sink_dir) if b > state.get("upto", -1)]
    done = done[: len(done) - keep] if keep else done
    if not done:
        return state.get("upto", -1)
    merged = f"merged={uuid.uuid4().hex[:12]}"
    _sums(_partials_since(spark, sink_dir, state, done[-1])).write.parquet(f"{sink_dir}/{merged}")
    retired = [f"batch_id={b}" for b in done] + _merged(state)
    if not log.commit(version, {"merged": merged, "upto": done[-1], "retired": retired}):
        commits.remove(spark, f"{sink_dir}/{merged}")  # another compaction came first
    return log.latest()[1]["upto"]


def rollup(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The rollup of all batches so far. A sink that no batch has written yet raises."""
    _, state = commits.Commits(spark, f"{sink_dir}/_merged").latest()
    return _sums(_partials_since(spark, sink_dir, state))
