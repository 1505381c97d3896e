"""Connection records derived from the driver's ``events`` table.

The test inputs have no network-flow table, so staging rows are derived from ``events``
with integer arithmetic and CASE only (FIXTURES.md section 3); the same mapping is
repeated in the DuckDB oracle. Every events row yields one staging row, so the work of
every query grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.sources.schema import conform

# Fixed values of the mapping (FIXTURES.md section 3).
BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
MONTH_SHIFT = 2678400  # 31 days in seconds
ATTACK_CATEGORIES = ["Fuzzers", "Analysis", "Backdoors", "DoS", "Exploits", "Generic", "Reconnaissance", "Shellcode", "Worms"]
PROTOCOLS = ["tcp", "udp", "tcp", "icmp", "arp"]
#: Rows of one task; at most so many tasks (a shuffle into up to 200 sorts and buffers no rows).
ROWS_PER_TASK, MAX_TASKS = 100_000, 200
STATES = ["CON", "INT", "ACC", "CLO", "FIN", None, "REQ"]


def _pick(index: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        value = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(index == i, value) if expr is None else expr.when(index == i, value)
    return expr


def raw_connections(events: DataFrame) -> DataFrame:
    """All derived rows, including the ones that break the staging rules."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    # TIMESTAMP_NTZ -> epoch seconds of the wall-clock time read as UTC (no zone lookup).
    epoch = F.unix_timestamp(F.col("ts"))
    # (x - x % 10) / 10 truncates toward zero, as does the cast of x / 10.
    compressed = ((epoch - F.lit(BASE_EPOCH)) / 10).cast("bigint")
    stime = F.lit(BASE_EPOCH) + compressed + (eid % 4) * MONTH_SHIFT
    attack_roll = (eid * 31 + uid) % 100 < 35
    category = _pick((eid * 17 + uid) % 9, ATTACK_CATEGORIES)
    service = (
        F.when(eid % 23 == 0, F.lit(None).cast("string"))
        .when(F.col("event_type") == "view", "http")
        .when(F.col("event_type") == "click", "dns")
        .when(F.col("event_type") == "purchase", "smtp")
        .when(F.col("event_type") == "signup", "ftp")
        .when(uid % 2 == 0, "ssh")
        .otherwise("-")
    )
    return events.select(
        F.concat(F.lit("59.166.0."), (uid % 10).cast("string")).alias("srcip"),
        F.when(eid % 97 == 0, F.lit(None)).otherwise(1024 + (eid * 7919) % 64512).cast("int").alias("sport"),
        F.concat(F.lit("149.171.126."), (eid % 10).cast("string")).alias("dstip"),
        F.when(eid % 89 == 0, F.lit(None))
        .when(attack_roll & (eid % 11 == 0), 31337 + eid % 5)
        .when(eid % 3 == 0, F.lit(53))
        .when(eid % 3 == 1, 20 + (eid * 13) % 1500)
        .otherwise((eid * 104729) % 30000)
        .cast("int")
        .alias("dsport"),
        _pick(eid % 5, PROTOCOLS).alias("proto"),
        _pick(eid % 7, STATES).alias("state"),
        F.col("value").alias("dur"),
        (40 + (eid * 37) % 15000).cast("bigint").alias("sbytes"),
        ((eid * 53) % 20000).cast("bigint").alias("dbytes"),
        (31 + (eid % 3) * 32).cast("int").alias("sttl"),
        ((eid % 2) * 29).cast("int").alias("dttl"),
        (eid % 4).cast("int").alias("sloss"),
        (eid % 6).cast("int").alias("dloss"),
        service.alias("service"),
        ((eid * 11) % 900000).cast("double").alias("sload"),
        ((eid * 7) % 700000).cast("double").alias("dload"),
        (1 + eid % 40).cast("int").alias("spkts"),
        (eid % 60).cast("int").alias("dpkts"),
        stime.alias("stime"),
        (stime + F.when(eid % 499 == 0, F.lit(-1)).otherwise(eid % 30)).alias("ltime"),
        (eid % 12).cast("int").alias("ct_srv_src"),
        (eid % 9).cast("int").alias("ct_srv_dst"),
        (eid % 3).cast("int").alias("ct_state_ttl"),
        F.when(attack_roll & (eid % 101 != 0), category).alias("attack_cat"),
        F.when(eid % 997 == 0, F.lit(2)).when(attack_roll, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("label"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The same rows, dealt evenly over tasks by their place in the file. A parquet file is only split
    between row groups, so a large group would otherwise be one task's work."""
    tasks = min(MAX_TASKS, -(-rows.count() // ROWS_PER_TASK))
    if tasks <= 1:
        return rows
    return rows.withColumn("_row", F.monotonically_increasing_id()).repartition(tasks, "_row").drop("_row")


def staging_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full 49-column staging view of the fixture (rule-breaking rows included)."""
    events = read_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    return conform(raw_connections(spread(events)))
