"""Mart-generation outputs: dimensions, fact, rollups, special facts, MVs and the
analytic queries (D1-D9, F3, R1-R4, R2i, R3i, F6, F7, R8-R11, H0, QA1-QM4).

Rollups and special facts are materialised once per mart (``DERIVED``) and then read
like the reference reads its tables. Results expose natural keys (names), never the
run-dependent fact ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowmart.functions import calendar as cal
from flowmart.functions.numeric import avg_finish, avg_parts, pct
from flowmart.operators import dims as D
from flowmart.operators import rollups as R
from flowmart.plans.mart import DERIVED, Derived, Mart, Window
from flowmart.plans.monthly import MONTH, month_of

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def ts_str(col: Column) -> Column:
    return F.date_format(col, TS_FMT)


# ---- materialised tables ----------------------------------------------------------------

def conn(m: Mart, w: Window = Window()) -> DataFrame:
    """The fact's rows of a window (its months are pruned) with attack flag and calendar columns."""
    return R.connections(w.has(m["fact_connection"]), m.dim("dim_attack"), w.t0, w.t1)


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, month_of("time_id"))


def _of(m: Mart, name: str, w: Window = Window()) -> DataFrame:
    """A table by month as it should be now, the window's months of it."""
    return w.has(m.derived(name)).drop(MONTH)


# Sources first. Peaks (R1, R2, R3), per-service and per-port columns (F6, F7) and the views look at the
# whole range, so those tables are finished anew from small stored sums when a month changes;
# what belongs to a month is rewritten for that month only.
DERIVED.update({
    "port_grain": Derived(lambda m, w: _by_month(R.port_grain(conn(m, w))), ("fact_connection",), by_month=True, local=True, hours=True),
    "port_words": Derived(lambda m, w: _by_month(R.port_words(conn(m, w), _of(m, "port_grain", w).filter(w.inside()))), ("fact_connection", "port_grain"), by_month=True, local=True, hours=True),
    "hourly_base": Derived(lambda m, w: _by_month(R.hourly_base(_of(m, "port_grain", w), _of(m, "port_words", w))), ("port_grain", "port_words"), by_month=True, local=True, hours=True),
    "fact_hourly_traffic": Derived(lambda m, w: _by_month(R.hourly_traffic(hourly_base(m))), ("hourly_base",), by_month=True),
    "fact_daily_traffic": Derived(lambda m, w: R.daily_traffic_literal(hourly_base(m), m["dim_time"]), ("hourly_base",)),
    "fact_monthly_traffic": Derived(lambda m, w: R.monthly_traffic_literal(hourly_base(m), m["dim_time"]), ("hourly_base",)),
    "fact_daily_traffic_declared": Derived(lambda m, w: _by_month(R.daily_traffic(_of(m, "hourly_base", w), m["dim_time"])), ("hourly_base",), by_month=True, local=True),
    "fact_monthly_traffic_declared": Derived(lambda m, w: _by_month(R.monthly_traffic(_of(m, "hourly_base", w), m["dim_time"])), ("hourly_base",), by_month=True, local=True),
    "daily_ports": Derived(lambda m, w: _by_month(R.period_ports(_of(m, "port_words", w), m["dim_time"], "day_start")), ("port_words",), by_month=True, local=True),
    "monthly_ports": Derived(lambda m, w: _by_month(R.period_ports(_of(m, "port_words", w), m["dim_time"], "month_start")), ("port_words",), by_month=True, local=True),
    "fact_service_stats": Derived(lambda m, w: R.service_stats(port_grain(m)), ("port_grain",)),
    "fact_port_usage": Derived(lambda m, w: R.port_usage(port_grain(m)), ("port_grain",)),
})


def hourly_base(m: Mart) -> DataFrame:
    """The additive hourly sums, stored by month."""
    return _of(m, "hourly_base")


def port_grain(m: Mart) -> DataFrame:
    """The sums per hour and destination port, stored by month: one scan of the fact."""
    return _of(m, "port_grain")


def port_words(m: Mart) -> DataFrame:
    """The port sets per hour, stored by month."""
    return _of(m, "port_words")


def hourly(m: Mart) -> DataFrame:
    """R1, stored by month (time-window readers prune partitions)."""
    return _of(m, "fact_hourly_traffic")


def daily_literal(m: Mart) -> DataFrame:
    return m.derived("fact_daily_traffic")


def monthly_literal(m: Mart) -> DataFrame:
    return m.derived("fact_monthly_traffic")


def daily_declared(m: Mart) -> DataFrame:
    return _of(m, "fact_daily_traffic_declared")


def monthly_declared(m: Mart) -> DataFrame:
    return _of(m, "fact_monthly_traffic_declared")


def service_stats(m: Mart) -> DataFrame:
    return m.derived("fact_service_stats")


def port_usage(m: Mart) -> DataFrame:
    return m.derived("fact_port_usage")


def named(df: DataFrame, m: Mart, *which: str) -> DataFrame:
    """Replace surrogate ids by natural names (broadcast lookups on size-checked dims)."""
    if "service" in which:
        df = df.join(m.dim("dim_service").select("service_id", F.col("name").alias("service_name")), "service_id").drop("service_id")
    if "protocol" in which:
        df = df.join(m.dim("dim_protocol").select("protocol_id", F.col("name").alias("protocol_name")), "protocol_id").drop("protocol_id")
    if "attack" in which:
        df = df.join(m.dim("dim_attack").select("attack_id", F.col("category").alias("attack_category")), "attack_id").drop("attack_id")
    if "port" in which:
        df = df.join(m.dim("dim_port").select("port_id", "port_number"), "port_id").drop("port_id")
    return df


# ---- dimensions ---------------------------------------------------------------------------

def _time_out(df: DataFrame) -> DataFrame:
    return df.withColumn("datetime", ts_str(F.col("datetime")))


def d1_calendar(m: Mart) -> DataFrame:
    """Hourly calendar from the first to the last observed hour (bounds from the data)."""
    bounds = m["dim_time"].agg(F.min("datetime").alias("t0"), F.max("datetime").alias("t1"))
    hours = bounds.select(F.explode(F.sequence("t0", "t1", F.expr("interval 1 hour"))).alias("datetime"))
    return _time_out(hours.select(*cal.hour_attributes(F.unix_seconds(F.col("datetime")))))


def d2_dim_time(m: Mart) -> DataFrame:
    return _time_out(m["dim_time"])


def d3_dim_service(m: Mart) -> DataFrame:
    return m["dim_service"].select("service_id", "name", "protocol", "service_type", "category", "risk_level", "is_active", "version")


def d4_dim_protocol(m: Mart) -> DataFrame:
    return m["dim_protocol"].select("protocol_id", "name", "type", "is_active")


def d5_dim_state(m: Mart) -> DataFrame:
    return m["dim_state"].select("state_id", "name", "category", "is_active")


def d6_dim_port(m: Mart) -> DataFrame:
    return m["dim_port"].select("port_id", "port_number", "range_type", "default_service", "is_active", "version")


def d7_dim_attack(m: Mart) -> DataFrame:
    return m["dim_attack"].select("attack_id", "category", "is_attack", "severity", "is_active")


def d9_dimension_counts(m: Mart) -> DataFrame:
    """Active rows per dimension (one small aggregate per dimension, unioned)."""
    parts = []
    for label, name in (("DIM_TIME", "dim_time"), ("DIM_SERVICE", "dim_service"), ("DIM_PROTOCOL", "dim_protocol"),
                        ("DIM_STATE", "dim_state"), ("DIM_PORT", "dim_port"), ("DIM_ATTACK", "dim_attack")):
        df = m[name]
        if "is_active" in df.columns:
            df = df.filter("is_active")
        parts.append(df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(label).alias("dimension"), "record_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def e1_dim_time(m: Mart) -> DataFrame:
    return m["g1_dim_time"].withColumn("timestamp", ts_str(F.col("timestamp")))


def e2_dim_service(m: Mart) -> DataFrame:
    return m["g1_dim_service"]


def e3_dim_protocol(m: Mart) -> DataFrame:
    return m["g1_dim_protocol"]


def e4_dim_location(m: Mart) -> DataFrame:
    return D.g1_dim_location(m.stg)


def e5_dim_attack_category(m: Mart) -> DataFrame:
    return m["g1_dim_attack_category"]


def e6_dim_attack(m: Mart) -> DataFrame:
    return m["g1_dim_attack"]


# ---- facts ----------------------------------------------------------------------------------

def f1_fact_connections(m: Mart) -> DataFrame:
    """the simple fact with natural keys (service name, protocol, category)."""
    f = m["g1_fact_connections"]
    f = f.join(m.dim("g1_dim_service"), "service_key", "left").join(m.dim("g1_dim_protocol"), "protocol_key").join(
        m.dim("g1_dim_attack").select("attack_key", "category_name", "is_attack"), "attack_key"
    )
    return f.select(
        "time_key", "src_ip", "src_port", "dst_ip", "dst_port", "service_name", "protocol_name", "protocol_state",
        "category_name", "is_attack", "duration", "src_bytes", "dst_bytes", "src_packets", "dst_packets",
        "total_bytes", "total_packets",
    )


def f3_fact_connection(m: Mart) -> DataFrame:
    """the mart fact with natural keys."""
    f = m["fact_connection"]
    sp = m.dim("dim_port").select(F.col("port_id").alias("source_port_id"), F.col("port_number").alias("source_port"))
    dp = m.dim("dim_port").select(F.col("port_id").alias("dest_port_id"), F.col("port_number").alias("dest_port"))
    st = m.dim("dim_state").select("state_id", F.col("name").alias("state_name"))
    f = named(f, m, "service", "protocol", "attack").join(sp, "source_port_id").join(dp, "dest_port_id").join(st, "state_id")
    return f.select(
        "time_id", "service_name", "source_port", "dest_port", "state_name", "protocol_name", "attack_category",
        F.col("duration").cast("double").alias("duration"), "source_bytes", "dest_bytes", "source_packets", "dest_packets",
        F.col("source_load").cast("double").alias("source_load"), F.col("dest_load").cast("double").alias("dest_load"),
        "source_ttl", "dest_ttl", "source_loss", "dest_loss", "ct_srv_src", "ct_srv_dst", "ct_state_ttl",
    )


# ---- rollups ----------------------------------------------------------------------------------

def r1_hourly_traffic(m: Mart) -> DataFrame:
    return named(hourly(m), m, "service", "protocol", "attack")


def r2_daily_traffic_literal(m: Mart) -> DataFrame:
    return named(daily_literal(m), m, "service", "protocol", "attack")


def r2i_daily_traffic(m: Mart) -> DataFrame:
    return named(daily_declared(m), m, "service", "protocol", "attack")


def r3_monthly_traffic_literal(m: Mart) -> DataFrame:
    return named(monthly_literal(m), m, "service", "protocol", "attack")


def r3i_monthly_traffic(m: Mart) -> DataFrame:
    return named(monthly_declared(m), m, "service", "protocol", "attack")


def f6_service_stats(m: Mart) -> DataFrame:
    return named(service_stats(m), m, "service", "protocol", "attack")


def f7_port_usage(m: Mart) -> DataFrame:
    return named(port_usage(m), m, "service", "protocol", "attack", "port").withColumn(
        "first_seen", ts_str(F.col("first_seen"))
    ).withColumn("last_seen", ts_str(F.col("last_seen")))


def refresh_rollups(m: Mart, t0: int | None = None, t1: int | None = None) -> list[int]:
    """Recompute the rollups for [t0, t1] from the fact, in three audited batches (HOURLY,
    DAILY, MONTHLY); returns the batch ids.

    The port grain, the port sets and the hourly base are the stored state: their rows of the
    window are computed anew and replace what was there. Of the tables by month only the
    months that the window touches are rewritten; the files of the others stay. Special facts
    and views that have been built are stale afterwards and follow on their next use. A rerun of
    the same window gives the same tables."""
    w = Window(m.months(t0, t1), t0, t1)
    whole_months = Window(w.months)

    def hourly_step(batch_id: int) -> int:
        for name in ("port_grain", "port_words", "hourly_base"):
            m.rebuild(name, w)
        m.mark_stale("port_grain", w.months)
        for name in ("port_words", "hourly_base"):  # these two are fresh
            m.fresh_again(name)
        return m.rebuild("fact_hourly_traffic").count()

    def daily_step(batch_id: int) -> int:
        return m.rebuild_all(["fact_daily_traffic", "fact_daily_traffic_declared", "daily_ports"], whole_months)["fact_daily_traffic"]

    def monthly_step(batch_id: int) -> int:
        return m.rebuild_all(["fact_monthly_traffic", "fact_monthly_traffic_declared", "monthly_ports"], whole_months)["fact_monthly_traffic"]

    return m.audit.run_all([("HOURLY", hourly_step), ("DAILY", daily_step), ("MONTHLY", monthly_step)])


def r4_aggregate_facts(m: Mart) -> DataFrame:
    """R4 over the whole range: level, status and rows of this run's batches, from the audit."""
    ids = refresh_rollups(m)
    return m.audit.table().filter(F.col("batch_id").isin(ids)).select("aggregation_level", "status", "records_processed")


#: A window strictly inside the data: it cuts the first and the third month's hours.
WINDOW = (1704171600, 1709535600)


def _window(m: Mart) -> Window:
    t0, t1 = WINDOW
    return Window(m.months(t0, t1), t0, t1)


def _window_base(m: Mart) -> DataFrame:
    """The hourly base of WINDOW, computed from the fact (months outside it are not read)."""
    rows = conn(m, _window(m))
    grain = R.port_grain(rows)
    return R.hourly_base(grain, R.port_words(rows, grain))


def r1_hourly_window(m: Mart) -> DataFrame:
    return named(R.hourly_traffic(_window_base(m)), m, "service", "protocol", "attack")


def r2_daily_window(m: Mart) -> DataFrame:
    return named(R.daily_traffic_literal(_window_base(m), m["dim_time"]), m, "service", "protocol", "attack")


def r3_monthly_window(m: Mart) -> DataFrame:
    return named(R.monthly_traffic_literal(_window_base(m), m["dim_time"]), m, "service", "protocol", "attack")


def r2_daily_distinct_ports(m: Mart) -> DataFrame:
    """Exact distinct source and destination ports per day, from the hours' port sets."""
    return named(_of(m, "daily_ports"), m, "service", "protocol", "attack")


def r3_monthly_distinct_ports(m: Mart) -> DataFrame:
    """Exact distinct source and destination ports per month, from the hours' port sets."""
    return named(_of(m, "monthly_ports"), m, "service", "protocol", "attack")


def r1_window_distinct_ports(m: Mart) -> DataFrame:
    """Exact distinct ports per service over WINDOW: the stored sets of its hours, merged."""
    w = _window(m)
    words = _of(m, "port_words", w).filter(w.inside())
    return named(R.distinct_ports(words, ["service_id"]), m, "service")


# ---- materialised views -------------------------------------------------------------------------

def r8_hourly_service_performance(m: Mart) -> DataFrame:
    ht = hourly(m)
    s = m.dim("dim_service").filter("is_active").select("service_id", F.col("name").alias("service_name"), "service_type", "risk_level")
    t = m.dim("dim_time").select("time_id", "hour", "is_business_hour")
    agg = ht.join(s, "service_id").join(t, "time_id").groupBy(
        "service_name", "service_type", "risk_level", "hour", "is_business_hour"
    ).agg(
        F.sum("total_connections").alias("total_connections"),
        F.sum("attack_connections").alias("attack_connections"),
        pct(F.sum("attack_connections"), F.sum("total_connections")).alias("avg_attack_percentage"),
        F.sum(F.col("total_bytes_normal") + F.col("total_bytes_attack")).alias("total_bytes"),
        *avg_parts("avg_duration", "avg_duration"),
    )
    return avg_finish(agg, "avg_duration")


def r9_daily_attack_patterns(m: Mart) -> DataFrame:
    dt = daily_literal(m)
    s = m.dim("dim_service").filter("is_active").select("service_id", F.col("name").alias("service_name"))
    a = m.dim("dim_attack").filter("is_active").select("attack_id", F.col("category").alias("attack_category"))
    t = m.dim("dim_time").select("time_id", "day_type")
    agg = dt.join(s, "service_id").join(a, "attack_id").join(t, "time_id").groupBy(
        "service_name", "attack_category", "day_type", "peak_hour"
    ).agg(
        F.sum("attack_connections").alias("total_attacks"),
        *avg_parts("attack_percentage", "avg_attack_percentage"),
        F.countDistinct("distinct_attack_types").alias("attack_varieties"),
    )
    return avg_finish(agg, "avg_attack_percentage")


def r10_service_risk_profile(m: Mart) -> DataFrame:
    ss = service_stats(m)
    s = m.dim("dim_service").filter("is_active").select("service_id", F.col("name").alias("service_name"), "service_type", "risk_level")
    agg = ss.join(s, "service_id").groupBy("service_name", "service_type", "risk_level").agg(
        F.countDistinct("distinct_attack_types").alias("total_attack_types"),
        *avg_parts("attack_percentage", "avg_attack_percentage"),
        F.max("peak_hour_attack").alias("common_attack_hour"),
        F.sum("exclusive_attack_ports").alias("exclusive_attack_ports"),
        *avg_parts("duration_ratio", "avg_duration_ratio"),
        *avg_parts("bytes_ratio", "avg_bytes_ratio"),
    )
    return avg_finish(agg, ["avg_attack_percentage", "avg_duration_ratio", "avg_bytes_ratio"])


def r11_port_security_analysis(m: Mart) -> DataFrame:
    pu = port_usage(m)
    p = m.dim("dim_port").filter("is_active").select("port_id", "port_number", "range_type")
    s = m.dim("dim_service").filter("is_active").select("service_id", F.col("name").alias("service_name"))
    agg = pu.join(p, "port_id").join(s, "service_id").groupBy("port_number", "range_type", "service_name").agg(
        F.countDistinct("primary_attack_type").alias("attack_types"),
        F.sum(F.when(F.col("exclusive_to_attacks"), 1).otherwise(0)).alias("exclusive_attack_count"),
        *avg_parts("attack_percentage", "avg_attack_percentage"),
        F.date_format(F.max("last_seen"), TS_FMT).alias("last_attack_seen"),
    )
    return avg_finish(agg, "avg_attack_percentage")


DERIVED.update({
    "mv_hourly_service_performance": Derived(lambda m, w: r8_hourly_service_performance(m), ("fact_hourly_traffic",)),
    "mv_daily_attack_patterns": Derived(lambda m, w: r9_daily_attack_patterns(m), ("fact_daily_traffic",)),
    "mv_service_risk_profile": Derived(lambda m, w: r10_service_risk_profile(m), ("fact_service_stats",)),
    "mv_port_security_analysis": Derived(lambda m, w: r11_port_security_analysis(m), ("fact_port_usage",)),
})


# ---- analytic queries ------------------------------------------------------------------------------

def last_24h(m: Mart) -> DataFrame:
    """H0: hour ids within 24 hours of the latest hour (inclusive); the bound is a scalar subquery."""
    t = m["dim_time"]
    max_dt = t.agg(F.max("datetime")).scalar()
    return t.filter(F.col("datetime") >= max_dt - F.expr("interval 24 hours")).select("time_id")


def h0_last_24h(m: Mart) -> DataFrame:
    return last_24h(m)


def recent(m: Mart, df: DataFrame, table: str | None = None) -> DataFrame:
    """Rows of a month-partitioned table in the last 24 hours (H0 as a predicate).

    ``datetime >= MAX(datetime) - 24h`` is ``time_id >= MAX(time_id) - 86400`` because
    ``time_id`` is the epoch of the hour. The bound is a scalar subquery; the matching
    ``year_month >= month(bound)`` predicate lets the scan prune whole month partitions,
    so only the last month or two are read whatever the table size."""
    bound = m["dim_time"].agg(F.max("time_id") - F.lit(86400)).scalar()
    src = m[table] if table else df
    pruned = src.filter(
        (F.col("year_month") >= F.date_format(cal.to_ts(bound), "yyyy-MM")) & (F.col("time_id") >= bound)
    )
    return pruned.drop("year_month") if "year_month" in pruned.columns else pruned


def _f(m: Mart) -> DataFrame:
    return m["fact_connection"]


def _attack(m: Mart) -> DataFrame:
    return m.dim("dim_attack").select("attack_id", "is_attack", F.col("category").alias("attack_type"), "severity")


def _service(m: Mart) -> DataFrame:
    return m.dim("dim_service").select("service_id", F.col("name").alias("service_name"))


def qa1_service_ranking(m: Mart) -> DataFrame:
    f = _f(m).join(_service(m), "service_id").join(_attack(m), "attack_id")
    att = F.sum(F.when(F.col("is_attack"), 1).otherwise(0))
    agg = f.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("total_connections"),
        att.alias("attack_connections"),
        pct(att, F.count(F.lit(1))).alias("attack_percentage"),
        *avg_parts("duration", "avg_duration"),
        F.sum(F.col("source_bytes") + F.col("dest_bytes")).alias("total_bytes"),
    )
    return avg_finish(agg, "avg_duration")


def qa2_attack_stats(m: Mart) -> DataFrame:
    f = _f(m).join(_service(m), "service_id").join(_attack(m), "attack_id").filter("is_attack")
    agg = f.groupBy("service_name", "attack_type").agg(
        F.count(F.lit(1)).alias("attack_count"),
        *avg_parts("duration", "avg_duration"),
        F.sum(F.col("source_bytes") + F.col("dest_bytes")).alias("total_bytes"),
    )
    return avg_finish(agg, "avg_duration")


def qa3_last_24h_volume(m: Mart) -> DataFrame:
    t = m.dim("dim_time").select("time_id", "hour", "day_type")
    f = recent(m, None, "fact_connection")
    f = f.join(_service(m), "service_id").join(t, "time_id").join(_attack(m), "attack_id")
    return f.groupBy("service_name", "day_type", "hour").agg(
        F.count(F.lit(1)).alias("connections"),
        F.sum(F.when(F.col("is_attack"), 1).otherwise(0)).alias("attacks"),
    )


def qb1_last_24h_normal(m: Mart) -> DataFrame:
    hourly(m)
    ht = recent(m, None, "fact_hourly_traffic")
    ht = ht.join(_service(m), "service_id").join(m.dim("dim_time").select("time_id", "hour"), "time_id")
    return ht.select(
        "service_name", "hour", "total_connections", "normal_connections",
        F.round(F.col("avg_duration_normal").cast("decimal(10,3)"), 2).cast("double").alias("avg_duration"),
        "total_bytes_normal", "total_packets_normal", "avg_load_normal",
    )


def qb2_port_usage_attacked(m: Mart) -> DataFrame:
    pu = port_usage(m).filter(F.col("attack_percentage") > 0)
    p = m.dim("dim_port").select("port_id", "port_number", "range_type")
    return pu.join(p, "port_id").select(
        "port_number", "range_type", "total_usage", "normal_usage", "attack_usage", "attack_percentage", "exclusive_to_attacks"
    )


def qb3_last_24h_by_hour(m: Mart) -> DataFrame:
    hourly(m)
    ht = recent(m, None, "fact_hourly_traffic")
    ht = ht.join(m.dim("dim_time").select("time_id", "hour", "is_business_hour"), "time_id")
    return ht.groupBy("hour", "is_business_hour").agg(
        F.sum("total_connections").alias("total_connections"),
        F.sum("attack_connections").alias("attack_connections"),
        pct(F.sum("attack_connections"), F.sum("total_connections")).alias("attack_percentage"),
    )


def qc1_attack_type_distribution(m: Mart) -> DataFrame:
    f = _f(m).join(_attack(m), "attack_id").filter("is_attack")
    agg = f.groupBy("attack_type", "severity").agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.countDistinct("service_id").alias("affected_services"),
        *avg_parts("duration", "avg_duration"),
    )
    return avg_finish(agg, "avg_duration")


def qc2_last_24h_attacks(m: Mart) -> DataFrame:
    f = recent(m, None, "fact_connection").join(_attack(m), "attack_id").filter("is_attack")
    f = f.join(m.dim("dim_time").select("time_id", "hour"), "time_id")
    agg = f.groupBy("hour", "attack_type").agg(
        F.count(F.lit(1)).alias("attack_count"),
        *avg_parts("duration", "avg_duration"),
        F.sum(F.col("source_bytes") + F.col("dest_bytes")).alias("total_bytes"),
    )
    return avg_finish(agg, "avg_duration")


def qc3_service_protocol_attack(m: Mart) -> DataFrame:
    f = _f(m).join(_service(m), "service_id").join(_attack(m), "attack_id").filter("is_attack")
    f = f.join(m.dim("dim_protocol").select("protocol_id", F.col("name").alias("protocol")), "protocol_id")
    agg = f.groupBy("service_name", "protocol", "attack_type").agg(
        F.count(F.lit(1)).alias("occurrences"), *avg_parts("duration", "avg_duration")
    )
    return avg_finish(agg, "avg_duration")


def qd1_latest_comparison(m: Mart) -> DataFrame:
    """Service stats of the latest hour (``time_id = MAX(time_id)`` of the hour dimension)."""
    latest = m["dim_time"].agg(F.max("time_id")).scalar()
    ss = service_stats(m).filter(F.col("time_id") == latest).join(_service(m), "service_id")
    return ss.select(
        "service_name", "total_connections", "normal_connections", "attack_connections",
        F.round(F.col("attack_percentage"), 2).alias("attack_percentage"),
        F.round(F.col("avg_duration_normal").cast("decimal(10,3)"), 2).cast("double").alias("avg_duration_normal"),
        F.round(F.col("avg_duration_attack").cast("decimal(10,3)"), 2).cast("double").alias("avg_duration_attack"),
        "total_bytes_normal", "total_bytes_attack",
    )


def qd2_service_risk_report(m: Mart) -> DataFrame:
    mv = r10_service_risk_profile(m)
    s = m.dim("dim_service").select(F.col("name").alias("service_name"), F.col("risk_level").alias("_risk"))
    return mv.join(s, "service_name").select(
        "service_name", F.col("_risk").alias("risk_level"), "total_attack_types", "avg_attack_percentage",
        "common_attack_hour", "exclusive_attack_ports",
    )


def qd3_port_usage_report(m: Mart) -> DataFrame:
    return r11_port_security_analysis(m).filter(F.col("avg_attack_percentage") > 0).select(
        "port_number", "range_type", "service_name", "attack_types", "exclusive_attack_count", "avg_attack_percentage",
        "last_attack_seen",
    )


def qd4_security_summary(m: Mart) -> DataFrame:
    """QD4 as written: the LEFT JOIN to port usage on (service, hour) repeats each fact row
    once per matching port-usage row, which weights the percentage.

    The weights are computed by aggregation instead of materialising the fan-out: per
    (service, hour) the number of matching port-usage rows ``w`` (1 when none), then
    ``sum(w * is_attack) / sum(w)`` - exact, and no row pairs are ever produced."""
    # The port grain has the facts' counts; its rows per (service, hour) are the weights.
    cells = port_grain(m).groupBy("service_id", "time_id").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("is_attack"), F.col("n")).otherwise(0)).alias("n_attack"), F.count(F.lit(1)).alias("w")
    )
    share = cells.agg(F.sum(F.col("n") * F.col("w")).alias("rows"), F.sum(F.col("n_attack") * F.col("w")).alias("attack_rows"))
    return _security_totals(m, share.select(pct(F.col("attack_rows"), F.col("rows"))).scalar())


def _security_totals(m: Mart, attack_share: Column) -> DataFrame:
    """Services, attack types and exclusive attack ports, from one aggregate of the port grain;
    every (service, hour) of the facts has port-usage rows, so all of them count."""
    per_port = port_grain(m).groupBy("port_id").agg(
        F.bool_and("is_attack").alias("exclusive"),
        F.collect_set("service_id").alias("services"),  # at most the service dimension
        F.collect_set(F.when(F.col("is_attack"), F.col("attack_id"))).alias("attacks"),
    )
    return per_port.agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("services")))).cast("bigint").alias("total_services"),
        F.size(F.array_distinct(F.flatten(F.collect_set("attacks")))).cast("bigint").alias("total_attack_types"),
        F.count(F.when(F.col("exclusive"), 1)).alias("exclusive_attack_ports"),
    ).select("total_services", "total_attack_types", attack_share.alias("overall_attack_percentage"), "exclusive_attack_ports")


def qd4_security_summary_fixed(m: Mart) -> DataFrame:
    """QD4 with independent scalars (no fan-out weighting)."""
    n = port_grain(m).agg(F.sum(F.when(F.col("is_attack"), F.col("n")).otherwise(0)).alias("a"), F.sum("n").alias("n"))
    return _security_totals(m, n.select(pct(F.col("a"), F.col("n"))).scalar())


def qm1_top5_attack_share(m: Mart) -> DataFrame:
    f = _f(m).join(_service(m), "service_id").join(_attack(m), "attack_id")
    agg = f.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("total_connections"),
        F.count(F.when(F.col("is_attack"), 1)).alias("attack_count"),
        pct(F.count(F.when(F.col("is_attack"), 1)), F.count(F.lit(1))).alias("attack_percentage"),
    )
    return agg.orderBy(F.col("attack_percentage").desc(), F.col("service_name")).limit(5)


def _share_of_total(agg: DataFrame, n: str) -> DataFrame:
    """``ROUND(100 * n / SUM(n) OVER (), 2)`` over the few aggregated rows."""
    return agg.withColumn("percentage_of_total", pct(F.col(n), F.sum(n).over(W.partitionBy())))


def qm2_attacks_by_hour(m: Mart) -> DataFrame:
    f = _f(m).join(_attack(m), "attack_id").filter("is_attack")
    agg = f.groupBy(F.hour(cal.to_ts(F.col("time_id"))).alias("hour")).agg(F.count(F.lit(1)).alias("total_attacks"))
    return _share_of_total(agg, "total_attacks")


def qm3_attack_categories(m: Mart) -> DataFrame:
    f = _f(m).join(_attack(m), "attack_id").filter("is_attack")
    agg = f.groupBy(F.col("attack_type").alias("category")).agg(F.count(F.lit(1)).alias("occurrences"))
    return _share_of_total(agg, "occurrences")


def qm4_mart_summary(m: Mart) -> DataFrame:
    """Seven counts in one row (each a one-row aggregate, cross-joined)."""
    def n(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return m.spark.range(1).select(  # one row carrying the scalar subqueries
        n(m["dim_service"].filter("is_active")).alias("active_services"),
        n(m["dim_attack"].filter("is_active")).alias("attack_categories"),
        n(m["fact_connection"]).alias("connection_facts"),
        n(hourly(m)).alias("hourly_aggregations"),
        n(daily_literal(m)).alias("daily_aggregations"),
        n(monthly_literal(m)).alias("monthly_aggregations"),
        n(port_usage(m)).alias("port_usage_records"),
    )
