"""Queries from the design documents (P1-P6) and the written requirements that have no
implementation in the reference (K1-K15), all on the mart generation.

Every query is one pass over the written fact (or a rollup) with broadcast dimension
lookups; ranks and period-over-period changes run on aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions import calendar as cal
from flowmart.functions.numeric import avg_finish, avg_parts, mean_raw, pct, r6, ratio, small_distinct
from flowmart.operators.facts import derived_metrics
from flowmart.plans import queries_g2 as G2
from flowmart.plans.mart import Mart
from flowmart.plans.quantiles import above_percentile


def _conn(m: Mart) -> DataFrame:
    """Fact rows with attack flag/category, calendar columns and the service name."""
    svc = m.dim("dim_service").select("service_id", F.col("name").alias("service_name"))
    return G2.conn(m).join(svc, "service_id")


def _dest_port(m: Mart) -> DataFrame:
    return m.dim("dim_port").select(F.col("port_id").alias("dest_port_id"), F.col("port_number").alias("dest_port"))


def p1_duration_anomalies(m: Mart) -> DataFrame:
    """Connections longer than the global 95th percentile (continuous), per service.

    The percentile is exact but computed without gathering the column in one task (see
    ``flowmart.plans.quantiles``)."""
    f = m["fact_connection"]
    bound = above_percentile(f, "duration", 95)
    svc = m.dim("dim_service").select("service_id", F.col("name").alias("service_name"))
    agg = f.filter(F.col("duration") >= bound).join(svc, "service_id").groupBy("service_name").agg(
        F.count(F.lit(1)).alias("connections"), *avg_parts("duration", "avg_duration")
    )
    return avg_finish(agg, "avg_duration")


def p2_hourly_load_profile(m: Mart) -> DataFrame:
    ht = G2.hourly(m).join(m.dim("dim_time").select("time_id", "hour"), "time_id")
    agg = ht.groupBy("hour").agg(F.sum("total_connections").alias("connections"), *avg_parts("avg_duration", "duration"))
    return avg_finish(agg, "duration")


def p3_service_protocol_attack_counts(m: Mart) -> DataFrame:
    f = G2.named(m["fact_connection"], m, "service", "protocol", "attack")
    return f.groupBy("service_name", "protocol_name", "attack_category").agg(F.count(F.lit(1)).alias("connections"))


def p4_monthly_trend(m: Mart) -> DataFrame:
    mt = G2.monthly_literal(m)
    mt = mt.join(m.dim("dim_service").select("service_id", F.col("name").alias("service_name")), "service_id")
    mt = mt.join(m.dim("dim_time").select("time_id", "month"), "time_id")
    return mt.select("service_name", "month", "total_connections", "attack_percentage")


def p5_attacks_per_service(m: Mart) -> DataFrame:
    f = _conn(m).filter("is_attack")
    return f.groupBy("service_name").agg(F.count(F.lit(1)).alias("attack_count"))


def p6_mean_hourly_connections(m: Mart) -> DataFrame:
    ht = G2.hourly(m).join(m.dim("dim_time").select("time_id", "hour"), "time_id")
    return avg_finish(ht.groupBy("hour").agg(*avg_parts("total_connections", "avg_connections")), "avg_connections")


def k1_by_day_of_week(m: Mart) -> DataFrame:
    """Connections, attacks and normal traffic per service and day of week (0 = Sunday)."""
    f = _conn(m).withColumn("day_of_week", cal.pg_dow(F.col("datetime")))
    return f.groupBy("service_name", "day_of_week").agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.count(F.when(F.col("is_attack"), 1)).alias("attack_connections"),
        F.count(F.when(~F.col("is_attack"), 1)).alias("normal_connections"),
    )


def k2_bytes_by_service_category(m: Mart) -> DataFrame:
    f = _conn(m).filter("is_attack")
    return f.groupBy("service_name", F.col("category").alias("attack_category")).agg(
        F.sum("source_bytes").alias("source_bytes"),
        F.sum("dest_bytes").alias("dest_bytes"),
        F.sum(F.col("source_bytes") + F.col("dest_bytes")).alias("total_bytes"),
    )


def k3_duration_by_category_service(m: Mart) -> DataFrame:
    f = _conn(m).filter("is_attack")
    agg = f.groupBy(F.col("category").alias("attack_category"), "service_name").agg(
        F.min("duration").cast("double").alias("min_duration"),
        *avg_parts("duration", "avg_duration"),
        F.max("duration").cast("double").alias("max_duration"),
    )
    return avg_finish(agg, "avg_duration")


def k4_top_ports_per_category(m: Mart) -> DataFrame:
    """Top-10 destination ports per attack category with use counts (RANK, ties kept).
    The window partition holds one row per port of the category (<= 65,536)."""
    f = _conn(m).filter("is_attack").join(_dest_port(m), "dest_port_id")
    agg = f.groupBy(F.col("category").alias("attack_category"), "dest_port").agg(F.count(F.lit(1)).alias("connection_count"))
    w = Window.partitionBy("attack_category").orderBy(F.col("connection_count").desc())
    return agg.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= 10)


def k5_attacks_by_category_time(m: Mart) -> DataFrame:
    """Attacks per category and service by hour, day and month: one GROUPING SETS pass."""
    f = _conn(m).filter("is_attack").withColumn("attack_category", F.col("category"))
    c, s, h, d, mo = (F.col(x) for x in ("attack_category", "service_name", "hour", "day", "month"))
    return f.groupingSets([[c, s, h], [c, s, d], [c, s, mo]], c, s, h, d, mo).agg(
        F.count(F.lit(1)).alias("attack_count"),
        F.when(F.grouping("hour") == 0, F.lit("hour")).when(F.grouping("day") == 0, F.lit("day")).otherwise(F.lit("month")).alias("grouping_type"),
    )


def _unit_sets(f: DataFrame, with_total: bool) -> DataFrame:
    """GROUPING SETS over (service, hour), (service, day), (service, month) [+ (service)]."""
    s, h, d, mo = (F.col(x) for x in ("service_name", "hour", "day", "month"))
    sets = [[s, h], [s, d], [s, mo]] + ([[s]] if with_total else [])
    return f.groupingSets(sets, s, h, d, mo)


def _unit_cols() -> list[Column]:
    unit = (
        F.when(F.grouping("hour") == 0, F.lit("hour"))
        .when(F.grouping("day") == 0, F.lit("day"))
        .when(F.grouping("month") == 0, F.lit("month"))
        .otherwise(F.lit("all"))
    )
    return [unit.alias("time_unit"), F.coalesce(F.col("hour"), F.col("day"), F.col("month")).alias("time_value")]


def k6_compare_by_unit(m: Mart) -> DataFrame:
    """Mean bytes and packets, normal vs attack, per service by hour, day and month with
    the unit kept (hour 5, day 5 and month 5 stay apart)."""
    f = _conn(m).withColumn("bytes", F.col("source_bytes") + F.col("dest_bytes")).withColumn(
        "packets", F.col("source_packets").cast("bigint") + F.col("dest_packets").cast("bigint")
    )
    ia = F.col("is_attack")
    agg = _unit_sets(f, False).agg(
        *_unit_cols(),
        *avg_parts(F.when(~ia, F.col("bytes")), "normal_avg_bytes"),
        *avg_parts(F.when(ia, F.col("bytes")), "attack_avg_bytes"),
        *avg_parts(F.when(~ia, F.col("packets")), "normal_avg_packets"),
        *avg_parts(F.when(ia, F.col("packets")), "attack_avg_packets"),
    ).drop("hour", "day", "month")
    return avg_finish(agg, ["normal_avg_bytes", "attack_avg_bytes", "normal_avg_packets", "attack_avg_packets"])


def k7_duration_by_unit(m: Mart) -> DataFrame:
    """Mean duration normal vs attack and their ratio, per service overall and by hour,
    day and month."""
    f = _conn(m)
    ia = F.col("is_attack")
    agg = _unit_sets(f, True).agg(
        *_unit_cols(),
        *avg_parts(F.when(~ia, F.col("duration")), "avg_normal"),
        *avg_parts(F.when(ia, F.col("duration")), "avg_attack"),
    ).drop("hour", "day", "month")
    agg = agg.withColumn("duration_ratio", ratio(mean_raw("avg_attack"), mean_raw("avg_normal")))
    return avg_finish(agg, ["avg_normal", "avg_attack"])


def k8_exclusive_ports_per_service(m: Mart) -> DataFrame:
    f = _conn(m).join(_dest_port(m), "dest_port_id")
    return (
        f.groupBy("service_name", "dest_port")
        .agg(F.bool_and("is_attack").alias("only_attacks"))
        .filter("only_attacks")
        .drop("only_attacks")
    )


def k9_top5_service_summary(m: Mart) -> DataFrame:
    """Summary of the 5 most attacked services (ties by name): totals and mean duration
    by class, their 5 most used destination ports, and active hours / days / months."""
    f = _conn(m)
    ia = F.col("is_attack")
    stats = f.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.count(F.when(~ia, 1)).alias("normal_connections"),
        F.count(F.when(ia, 1)).alias("attack_connections"),
        *avg_parts(F.when(~ia, F.col("duration")), "avg_duration_normal"),
        *avg_parts(F.when(ia, F.col("duration")), "avg_duration_attack"),
        small_distinct("hour").alias("active_hours"),
        small_distinct("day").alias("active_days"),
        small_distinct("month").alias("active_months"),
    )
    top = stats.orderBy(F.col("attack_connections").desc(), F.col("service_name")).limit(5)
    # Port counts come from the port grain; the five services are picked when the two small
    # sides meet, so the per-service aggregate runs once.
    ports = (
        G2.port_grain(m).groupBy("service_id", "port_id").agg(F.sum("n").alias("n"))
        .join(m.dim("dim_service").select("service_id", F.col("name").alias("service_name")), "service_id")
        .join(m.dim("dim_port").select("port_id", F.col("port_number").alias("dest_port")), "port_id")
    )
    w = Window.partitionBy("service_name").orderBy(F.col("n").desc(), F.col("dest_port"))
    top_ports = (
        ports.withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") <= 5)
        .groupBy("service_name")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "dest_port"))), lambda x: x["dest_port"].cast("string")), ",").alias("top_ports"))
    )
    out = top.join(top_ports, "service_name", "left")
    return avg_finish(out, ["avg_duration_normal", "avg_duration_attack"])


#: The widest cross-tab; protocols beyond it (in name order) are counted in ``other``.
PIVOT_MOST = 200


def k10_service_protocol_matrix(m: Mart) -> DataFrame:
    f = G2.named(m["fact_connection"], m, "service", "protocol")
    return f.groupBy("service_name", "protocol_name").agg(F.count(F.lit(1)).alias("connections"))


def k10_port_service_matrix(m: Mart) -> DataFrame:
    f = G2.named(m["fact_connection"], m, "service").join(_dest_port(m), "dest_port_id")
    return f.groupBy("dest_port", "service_name").agg(F.count(F.lit(1)).alias("connections"))


def k10_attack_service_matrix(m: Mart) -> DataFrame:
    f = G2.named(m["fact_connection"], m, "service", "attack")
    return f.groupBy("attack_category", "service_name").agg(F.count(F.lit(1)).alias("connections"))


def pivot_protocols(m: Mart) -> list[str]:
    """The names of the protocol dimension without the default member: PIVOT_MOST of them at most."""
    names = m["dim_protocol"].filter("protocol_id <> 0").select("name").orderBy("name").limit(PIVOT_MOST)
    return [r[0] for r in names.collect()]


def k10_service_protocol_pivot(m: Mart, protocols: list[str] | None = None) -> DataFrame:
    """Wide form of the service x protocol matrix: one column for each of ``protocols`` (all of the
    dimension, if not given) and ``other`` for the connections of any other or no protocol."""
    protocols = pivot_protocols(m) if protocols is None else protocols
    f = G2.named(m["fact_connection"], m, "service", "protocol")
    n = lambda when: F.count(F.when(when, 1))
    column = lambda p: f"{p}_" if p in ("other", "service_name") else p
    named = F.col("protocol_name").isin(protocols)
    return f.groupBy("service_name").agg(*[n(F.col("protocol_name") == p).alias(column(p)) for p in protocols], n(~named).alias("other"))


def k11_derived_metrics(m: Mart) -> DataFrame:
    f = derived_metrics(G2.named(m["fact_connection"], m, "service"))
    return f.select(
        "time_id", "service_name", "source_bytes", "dest_bytes",
        r6(F.col("transfer_rate")).alias("transfer_rate"), r6(F.col("packet_loss_ratio")).alias("packet_loss_ratio"),
    )


def k12_monthly_trend_changes(m: Mart) -> DataFrame:
    """Month-over-month change of connections and attack share per service (from the
    monthly rollup; the window sees one row per service and month)."""
    mt = G2.monthly_declared(m).join(m.dim("dim_service").select("service_id", F.col("name").alias("service_name")), "service_id")
    mt = mt.withColumn("month", F.date_format(cal.to_ts(F.col("time_id")), "yyyy-MM"))
    per = mt.groupBy("service_name", "month").agg(
        F.sum("total_connections").alias("total_connections"), F.sum("attack_connections").alias("attack_connections")
    ).withColumn("attack_percentage", pct(F.col("attack_connections"), F.col("total_connections")))
    w = Window.partitionBy("service_name").orderBy("month")
    prev_n = F.lag("total_connections").over(w)
    prev_p = F.lag("attack_percentage").over(w)
    return per.select(
        "service_name", "month", "total_connections", "attack_percentage",
        (F.col("total_connections") - prev_n).alias("delta_connections"),
        pct(F.col("total_connections") - prev_n, prev_n).alias("pct_change"),
        F.round(F.col("attack_percentage") - prev_p, 2).alias("delta_attack_percentage"),
    )


def k13_first_seen_threats(m: Mart) -> DataFrame:
    f = _conn(m).filter("is_attack")
    return f.groupBy("service_name", F.col("category").alias("attack_category")).agg(
        F.date_format(F.min("datetime"), G2.TS_FMT).alias("first_seen")
    )


def k14_protocol_safety(m: Mart) -> DataFrame:
    f = G2.conn(m).join(m.dim("dim_protocol").select("protocol_id", F.col("name").alias("protocol_name")), "protocol_id")
    return f.groupBy("protocol_name").agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.count(F.when(F.col("is_attack"), 1)).alias("attack_connections"),
        pct(F.count(F.when(F.col("is_attack"), 1)), F.count(F.lit(1))).alias("attack_percentage"),
    )


def k15_overload_hours(m: Mart) -> DataFrame:
    """Hours of day among the 3 busiest per service (RANK over 24 aggregated rows)."""
    agg = _conn(m).groupBy("service_name", "hour").agg(F.count(F.lit(1)).alias("connections"))
    w = Window.partitionBy("service_name").orderBy(F.col("connections").desc())
    return agg.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= 3)
