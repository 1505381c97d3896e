"""Analytic queries of the simple generation (A1-D4q) and its rollups.

All read the written simple-generation fact. Service and attack lookups are broadcast
joins against size-checked dimensions; calendar attributes are derived from the fact's
``time_key`` (epoch seconds, the calendar dimension's key) instead of joining a
dimension that has one row per second. Multi-level groupings are one ``GROUPING SETS``
pass (one scan, one shuffle) rather than a union of three scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.plans.mart import Mart

from flowmart.functions.numeric import avg_finish, avg_parts, mean_raw, pct, r6, ratio, small_distinct


def _ts(m: Mart) -> Column:
    return F.timestamp_seconds(F.col("time_key"))


def fact(m: Mart, *dims: str) -> DataFrame:
    """The simple fact with the requested lookups joined (``service``, ``attack``)."""
    f = m["g1_fact_connections"]
    if "service" in dims:
        f = f.join(m.dim("g1_dim_service"), "service_key", "inner")
    if "attack" in dims:
        f = f.join(m.dim("g1_dim_attack").select("attack_key", "category_name", "is_attack"), "attack_key", "inner")
    if "time" in dims:
        ts = _ts(m)
        f = f.withColumn("hour", F.hour(ts)).withColumn("day", F.dayofmonth(ts)).withColumn("month", F.month(ts))
    return f


def a1_service_ranking(m: Mart) -> DataFrame:
    return fact(m, "service").groupBy("service_name").agg(F.count(F.lit(1)).alias("total_connections"))


def a2_attack_categories(m: Mart) -> DataFrame:
    return (
        fact(m, "service", "attack")
        .filter(F.col("is_attack"))
        .groupBy("service_name")
        .agg(F.count(F.lit(1)).alias("attack_connections"), F.countDistinct("category_name").alias("attack_categories"))
    )


def a3_attack_share(m: Mart) -> DataFrame:
    counts = (
        fact(m, "service", "attack")
        .groupBy("service_name")
        .agg(
            F.count(F.lit(1)).alias("total_connections"),
            F.sum(F.when(F.col("is_attack"), 1).otherwise(0)).alias("attack_connections"),
        )
        .filter(F.col("total_connections") > 1000)
    )
    t, a = F.col("total_connections"), F.col("attack_connections")
    return counts.select("service_name", t, pct(a, t).alias("attack_percentage"), pct(t - a, t).alias("normal_percentage"))


def _grain_label() -> Column:
    return F.when(F.grouping("hour") == 0, F.lit("hour")).when(F.grouping("day") == 0, F.lit("day")).otherwise(F.lit("month"))


def _by_hour_day_month(df: DataFrame, measure: str) -> DataFrame:
    svc, h, d, mo = F.col("service_name"), F.col("hour"), F.col("day"), F.col("month")
    return df.groupingSets([[svc, h], [svc, d], [svc, mo]], svc, h, d, mo).agg(
        F.count(F.lit(1)).alias(measure), _grain_label().alias("grouping_type")
    )


def a4_attacks_by_time(m: Mart) -> DataFrame:
    return _by_hour_day_month(fact(m, "service", "attack", "time").filter(F.col("is_attack")), "total_attacks")


def b1_normal_totals(m: Mart) -> DataFrame:
    return (
        fact(m, "service", "attack")
        .filter(~F.col("is_attack"))
        .groupBy("service_name")
        .agg(
            F.sum("src_bytes").alias("total_src_bytes"),
            F.sum("dst_bytes").alias("total_dst_bytes"),
            F.sum("src_packets").alias("total_src_packets"),
            F.sum("dst_packets").alias("total_dst_packets"),
        )
    )


def b2_normal_duration(m: Mart) -> DataFrame:
    return (
        fact(m, "service", "attack")
        .filter(~F.col("is_attack"))
        .groupBy("service_name")
        .agg(*avg_parts("duration", "avg_duration"))
        .transform(lambda d: avg_finish(d, "avg_duration"))
    )


def b3_top_normal_ports(m: Mart) -> DataFrame:
    """Top-5 destination ports per service in normal traffic; RANK keeps ties.

    The window runs over (service, port) aggregates: one partition per service holds at
    most 65,536 rows whatever the data volume.
    """
    agg = (
        fact(m, "service", "attack")
        .filter(~F.col("is_attack"))
        .groupBy("service_name", "dst_port")
        .agg(F.count(F.lit(1)).alias("connection_count"))
    )
    w = Window.partitionBy("service_name").orderBy(F.col("connection_count").desc())
    return agg.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= 5)


def b4_normal_by_time(m: Mart) -> DataFrame:
    return _by_hour_day_month(fact(m, "service", "attack", "time").filter(~F.col("is_attack")), "normal_connections")


def c1_attack_bytes(m: Mart) -> DataFrame:
    return (
        fact(m, "service", "attack")
        .filter(F.col("is_attack"))
        .groupBy("service_name", "is_attack")
        .agg(F.sum(F.col("src_bytes") + F.col("dst_bytes")).alias("total_bytes"))
        .select(
            "service_name",
            F.when(F.col("is_attack"), F.lit("Attack")).otherwise(F.lit("Normal")).alias("traffic_type"),
            "total_bytes",
        )
    )


def c2_attack_duration(m: Mart) -> DataFrame:
    return (
        fact(m, "service", "attack")
        .filter(F.col("is_attack"))
        .groupBy("service_name")
        .agg(
            r6(F.min("duration")).alias("min_duration"),
            *avg_parts("duration", "avg_duration"),
            r6(F.max("duration")).alias("max_duration"),
        )
        .transform(lambda d: avg_finish(d, "avg_duration"))
        .select("service_name", F.lit("Attack").alias("traffic_type"), "min_duration", "avg_duration", "max_duration")
    )


def c3_top_attack_ports(m: Mart) -> DataFrame:
    """Top-10 destination ports in attacks, global RANK (ties kept).

    The global window sees one row per port (<= 65,536 rows) after the aggregation.
    """
    agg = fact(m, "attack").filter(F.col("is_attack")).groupBy("dst_port").agg(F.count(F.lit(1)).alias("usage_count"))
    return agg.withColumn("rank", F.rank().over(Window.orderBy(F.col("usage_count").desc()))).filter(F.col("rank") <= 10)


def c4_attacks_by_time(m: Mart) -> DataFrame:
    return _by_hour_day_month(fact(m, "service", "attack", "time").filter(F.col("is_attack")), "attack_count")


def d1q_compare_literal(m: Mart) -> DataFrame:
    """Normal vs attack means by GROUPING SETS (hour), (day), (month), then merged on
    ``COALESCE(hour, day, month)`` - hour 5, day 5 and month 5 collide, MAX picks one
    (reproduced as written; ``k6_compare_by_unit`` keeps the units apart)."""
    f = fact(m, "service", "attack", "time")
    svc, ia, h, d, mo = (F.col(c) for c in ("service_name", "is_attack", "hour", "day", "month"))
    stats = f.groupingSets([[svc, ia, h], [svc, ia, d], [svc, ia, mo]], svc, ia, h, d, mo).agg(
        F.avg(F.col("src_bytes") + F.col("dst_bytes")).alias("avg_bytes"),
        F.avg(F.col("src_packets") + F.col("dst_packets")).alias("avg_packets"),
    )
    return (
        stats.groupBy("service_name", F.coalesce(h, d, mo).alias("time_unit"))
        .agg(
            r6(F.max(F.when(ia, F.col("avg_bytes")))).alias("malicious_avg_bytes"),
            r6(F.max(F.when(~ia, F.col("avg_bytes")))).alias("normal_avg_bytes"),
            r6(F.max(F.when(ia, F.col("avg_packets")))).alias("malicious_avg_packets"),
            r6(F.max(F.when(~ia, F.col("avg_packets")))).alias("normal_avg_packets"),
        )
    )


def d2q_duration_ratio(m: Mart) -> DataFrame:
    f = fact(m, "service", "attack")
    agg = f.groupBy("service_name").agg(
        *avg_parts(F.when(F.col("is_attack"), F.col("duration")), "avg_attack_duration"),
        *avg_parts(F.when(~F.col("is_attack"), F.col("duration")), "avg_normal_duration"),
    )
    agg = agg.withColumn("duration_ratio", ratio(mean_raw("avg_attack_duration"), mean_raw("avg_normal_duration")))
    return avg_finish(agg, ["avg_attack_duration", "avg_normal_duration"])


def d3q_attack_only_ports(m: Mart) -> DataFrame:
    return (
        fact(m, "attack")
        .groupBy("dst_port")
        .agg(F.bool_and("is_attack").alias("attack_only"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("attack_only"))
        .select(F.col("dst_port").alias("port"))
    )


def d4q_top_attacked_services(m: Mart) -> DataFrame:
    """Top 5 services by attack count (ties broken by name) with a per-service summary.

    ``common_ports`` is the sorted distinct destination-port list joined by ','; it is
    bounded by the port domain. Active hours / days / months are small-domain distinct
    counts (bitmask popcount), so the aggregate needs no Expand.
    """
    f = fact(m, "service", "attack", "time")
    stats = f.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.sum(F.when(F.col("is_attack"), 1).otherwise(0)).alias("attack_count"),
        *avg_parts("duration", "avg_duration"),
        F.array_join(F.sort_array(F.collect_set("dst_port")), ",").alias("common_ports"),
        small_distinct("hour").alias("active_hours"),
        small_distinct("day").alias("active_days"),
        small_distinct("month").alias("active_months"),
    )
    return (
        avg_finish(stats, "avg_duration")
        .withColumn(
            "attack_percentage", r6(F.col("attack_count").cast("double") / F.col("total_connections") * 100)
        )
        .orderBy(F.col("attack_count").desc(), F.col("service_name"))
        .limit(5)
    )


# ---- simple-generation rollups (materialized views) -----------------------------------

def r5_hourly_service_stats(m: Mart) -> DataFrame:
    f = fact(m, "service", "attack", "time")
    agg = f.groupBy("service_name", "hour", "is_attack").agg(
        F.count(F.lit(1)).alias("connection_count"),
        F.sum(F.col("src_bytes") + F.col("dst_bytes")).alias("total_bytes"),
        *avg_parts("duration", "avg_duration"),
    )
    return avg_finish(agg, "avg_duration")


def _traffic_mv(m: Mart, key: Column, key_name: str) -> DataFrame:
    f = fact(m, "attack")
    f = f.join(m.dim("g1_dim_service"), "service_key", "left").join(
        m.dim("g1_dim_protocol"), "protocol_key", "inner"
    )
    agg = f.groupBy(
        key.alias(key_name), "service_name", "protocol_name", "protocol_state", "category_name", "is_attack"
    ).agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.sum("total_bytes").alias("total_bytes"),
        F.sum("total_packets").alias("total_packets"),
        *avg_parts("duration", "avg_duration"),
        r6(F.sum(F.when(F.col("is_attack"), 1).otherwise(0)).cast("double") / F.count(F.lit(1))).alias("attack_rate"),
    )
    return avg_finish(agg, "avg_duration")


def r6_daily_traffic(m: Mart) -> DataFrame:
    """Daily MV keyed by day of month (as written), service, protocol, attack."""
    return _traffic_mv(m, F.dayofmonth(F.timestamp_seconds("time_key")).cast("int"), "day_key")


def r7_weekly_traffic(m: Mart) -> DataFrame:
    """Weekly MV keyed by ISO week number (no year, as written)."""
    return _traffic_mv(m, F.weekofyear(F.timestamp_seconds("time_key")).cast("int"), "week_key")
