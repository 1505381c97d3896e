"""Connection fact builders.

Each dimension lookup is an equi-join against a small, size-checked dimension; the
caller passes dimensions already wrapped by ``flowmart.plans.joins.sized`` so they are
broadcast when their counted size allows it and shuffle-joined otherwise. The fact side
is never shuffled for a broadcast lookup, and all lookups run in one stage.

The column names of the facts are fixed values (the declared schema).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.functions import calendar as cal

DEC = "decimal(10,3)"


def year_month(epoch_col: str) -> F.Column:
    return F.date_format(F.timestamp_seconds(F.col(epoch_col)), "yyyy-MM")


# --------------------------------------------------------------------------------------
# Mart generation
# --------------------------------------------------------------------------------------

def g2_measures(stg: DataFrame) -> DataFrame:
    """Staging rows with the fact's typed measures (NUMERIC(10,3) via ``try_cast``)."""
    c = F.col
    return stg.select(
        "service", "sport", "dsport", "state", "proto", "attack_cat", "stime",
        "dur", "sload", "dload",
        c("dur").try_cast(DEC).alias("duration"),
        c("sbytes").cast("bigint").alias("source_bytes"),
        c("dbytes").cast("bigint").alias("dest_bytes"),
        c("spkts").cast("int").alias("source_packets"),
        c("dpkts").cast("int").alias("dest_packets"),
        c("sload").try_cast(DEC).alias("source_load"),
        c("dload").try_cast(DEC).alias("dest_load"),
        c("sttl").alias("source_ttl"),
        c("dttl").alias("dest_ttl"),
        c("sloss").alias("source_loss"),
        c("dloss").alias("dest_loss"),
        "ct_srv_src", "ct_srv_dst", "ct_state_ttl",
    )


def g2_fact_connection(stg: DataFrame, service: DataFrame, port: DataFrame, state: DataFrame,
                       protocol: DataFrame, attack: DataFrame, batch_id: int) -> DataFrame:
    """one fact row per clean staging row with a start time.

    Six LEFT lookups on active members; misses map to the default member 0. The attack
    lookup uses ``COALESCE(attack_cat, 'NORMAL')``. ``time_id`` is the epoch of the hour
    start, which is also the hour dimension's key (so the calendar lookup needs no join).
    """
    m = g2_measures(stg.filter(F.col("stime").isNotNull()))
    svc = service.filter("is_active").select(F.col("name").alias("_svc"), "service_id")
    sp = port.filter("is_active").select(F.col("port_number").alias("_sp"), F.col("port_id").alias("source_port_id"))
    dp = port.filter("is_active").select(F.col("port_number").alias("_dp"), F.col("port_id").alias("dest_port_id"))
    st = state.filter("is_active").select(F.col("name").alias("_st"), "state_id")
    pr = protocol.filter("is_active").select(F.col("name").alias("_pr"), "protocol_id")
    at = attack.filter("is_active").select(F.col("category").alias("_at"), "attack_id")
    j = (
        m.join(svc, m["service"] == svc["_svc"], "left")
        .join(sp, m["sport"] == sp["_sp"], "left")
        .join(dp, m["dsport"] == dp["_dp"], "left")
        .join(st, m["state"] == st["_st"], "left")
        .join(pr, m["proto"] == pr["_pr"], "left")
        .join(at, F.coalesce(m["attack_cat"], F.lit("NORMAL")) == at["_at"], "left")
    )
    time_id = cal.hour_start(F.col("stime"))
    return j.select(
        F.monotonically_increasing_id().alias("connection_id"),
        time_id.alias("time_id"),
        *[F.coalesce(F.col(k), F.lit(0)).cast("int").alias(k)
          for k in ("service_id", "source_port_id", "dest_port_id", "state_id", "protocol_id", "attack_id")],
        "duration", "source_bytes", "dest_bytes", "source_packets", "dest_packets",
        "source_load", "dest_load", "source_ttl", "dest_ttl", "source_loss", "dest_loss",
        "ct_srv_src", "ct_srv_dst", "ct_state_ttl",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.date_format(F.timestamp_seconds(time_id), "yyyy-MM").alias("year_month"),
    )


def derived_metrics(fact: DataFrame) -> DataFrame:
    """Transfer rate (bytes per second) and packet-loss ratio, NULL when undefined."""
    c = F.col
    total_bytes = c("source_bytes") + c("dest_bytes")
    total_packets = c("source_packets") + c("dest_packets")
    return fact.withColumn(
        "transfer_rate", F.try_divide(total_bytes.cast("double"), c("duration").cast("double"))
    ).withColumn(
        "packet_loss_ratio",
        F.try_divide((c("source_loss") + c("dest_loss")).cast("double"), total_packets.cast("double")),
    )


# --------------------------------------------------------------------------------------
# Simple generation (G1)
# --------------------------------------------------------------------------------------

def g1_valid_connections(stg: DataFrame) -> DataFrame:
    """S12 without the sample: numeric (non-null) ports and a start time."""
    return stg.filter(F.col("sport").isNotNull() & F.col("dsport").isNotNull() & F.col("stime").isNotNull())


def g1_fact_connections(stg: DataFrame, service: DataFrame, protocol: DataFrame, attack: DataFrame) -> DataFrame:
    """F1 + F2: the simple-generation connection fact.

    INNER time (key = epoch second, always present for a non-null start time), INNER
    source/destination location (natural key (ip, port) kept on the fact; a NULL part
    drops the row exactly like the equi-join), LEFT service, INNER protocol on
    (proto, state) - a NULL state drops the row - and INNER attack on
    (category, label = 1) with one dimension row per pair.
    """
    v = g1_valid_connections(stg).filter(F.col("srcip").isNotNull() & F.col("dstip").isNotNull())
    svc = service.select(F.col("service_name").alias("_svc"), "service_key")
    pr = protocol.select(F.col("protocol_name").alias("_pn"), F.col("protocol_state").alias("_ps"), "protocol_key")
    at = attack.filter(F.col("is_attack").isNotNull()).select(
        F.col("category_name").alias("_cat"), F.col("is_attack").alias("_ia"), "attack_key"
    )
    j = (
        v.join(svc, v["service"] == svc["_svc"], "left")
        .join(pr, (v["proto"] == pr["_pn"]) & (v["state"] == pr["_ps"]), "inner")
        .join(at, v["attack_cat"].eqNullSafe(at["_cat"]) & ((v["label"] == 1) == at["_ia"]), "inner")
    )
    c = F.col
    return j.select(
        F.monotonically_increasing_id().alias("fact_key"),
        c("stime").alias("time_key"),
        c("srcip").alias("src_ip"),
        c("sport").alias("src_port"),
        c("dstip").alias("dst_ip"),
        c("dsport").alias("dst_port"),
        "service_key",
        "protocol_key",
        "attack_key",
        c("dur").alias("duration"),
        c("sbytes").alias("src_bytes"),
        c("dbytes").alias("dst_bytes"),
        c("spkts").cast("bigint").alias("src_packets"),
        c("dpkts").cast("bigint").alias("dst_packets"),
        (c("sbytes") + c("dbytes")).alias("total_bytes"),
        (c("spkts").cast("bigint") + c("dpkts").cast("bigint")).alias("total_packets"),
        F.date_format(F.timestamp_seconds(c("stime")), "yyyy-MM").alias("year_month"),
    )
