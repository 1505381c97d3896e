"""Queries over the load, sink, validation, versioning and streaming operators
(S1-S21, V1-V9, D10, R12, X1). Operators that write files write under the mart's
folder in the shared checkpoint location and return the re-read result."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.classify import ATTACK_SEVERITY, ATTACK_SEVERITY_DEFAULT, MAX_PORT, UNKNOWN, lookup, port_range
from flowmart.operators import dims as D
from flowmart.operators import quality as QL
from flowmart.operators import scd
from flowmart.operators import sinks
from flowmart.operators import validation as V
from flowmart.operators.facts import g1_valid_connections
from flowmart.plans import queries_g1 as G1
from flowmart.operators.sinks import RangePartitions
from flowmart.operators.tables import distinct_rows, write_table
from flowmart.operators.temporal import resolve_as_of
from flowmart.plans import queries_g2 as G2
from flowmart.plans.batches import BatchedMart
from flowmart.plans.joins import sized
from flowmart.plans.mart import DERIVED, Derived, Mart
from flowmart.sources import csv as CSV
from flowmart.sources.fixture import read_events
from flowmart.sources.schema import STAGING_FIELDS
from flowmart.streaming import hourly as X

USED = ["srcip", "sport", "dstip", "dsport", "proto", "state", "dur", "sbytes", "dbytes", "sttl", "dttl", "sloss", "dloss",
        "service", "sload", "dload", "spkts", "dpkts", "stime", "ltime", "ct_srv_src", "ct_srv_dst", "ct_state_ttl",
        "attack_cat", "label"]


# ---- sources -----------------------------------------------------------------------------

def s1_csv_with_header(m: Mart) -> DataFrame:
    """Clean staging written as CSV with a header, read back with the explicit schema."""
    path = m.scratch("csv_header")
    m.stg.write.mode("overwrite").option("header", True).csv(path)
    return CSV.read_with_header(m.spark, path).select(*USED)


def s3_parse_raw_lines(m: Mart) -> DataFrame:
    """S3: raw staging (rule breakers included) written as headerless positional lines,
    read back and parsed into the 49 typed fields."""
    path = m.scratch("raw_lines")
    CSV.write_lines(m.raw, path)
    return CSV.parse_lines(CSV.read_raw_lines(m.spark, path)).select(*USED)


def s2_line_numbers(m: Mart) -> DataFrame:
    """S2 + S4: raw staging written as lines with a blank line before every line whose source port
    is a multiple of 5, read back: lines kept, distinct (file, line number) pairs, and the sum
    of the files' last line numbers, which counts the dropped blank lines too."""
    path = m.scratch("numbered_lines")
    value = F.concat_ws(",", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in STAGING_FIELDS])
    blank = F.when(F.col("sport") % 5 == 0, F.concat(F.lit("\n"), value)).otherwise(value)
    m.raw.select(blank.alias("value")).write.mode("overwrite").text(path)
    lines = CSV.read_raw_lines(m.spark, path)
    per_file = lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("line_number").alias("d"), F.max("line_number").alias("last"))
    zero = F.lit(0).cast("bigint")
    return per_file.agg(*[F.coalesce(F.sum(c), zero).alias(name) for c, name in (("n", "lines"), ("d", "distinct_numbers"), ("last", "physical_lines"))])


def s8_load_errors(m: Mart) -> DataFrame:
    """Load errors of lines broken on purpose: a word in place of the duration where the source
    port is a multiple of 7, of the start time where it is a multiple of 11."""
    path = m.scratch("broken_lines")
    word = {"dur": F.col("sport") % 7 == 0, "stime": F.col("sport") % 11 == 0}
    fields = [F.coalesce(F.when(word[n], F.lit("x")) if n in word else F.lit(None).cast("string"), F.col(n).cast("string"), F.lit("")) for n, _ in STAGING_FIELDS]
    m.raw.select(F.concat_ws(",", *fields).alias("value")).write.mode("overwrite").text(path)
    errors = CSV.parse_errors(CSV.read_raw_lines(m.spark, path))
    part = lambda i: F.split_part("raw_data", F.lit(","), F.lit(i))
    return errors.select("error_message", part(1).alias("srcip"), part(2).cast("int").alias("sport"), part(3).alias("dstip"), (F.col("line_number") > 0).alias("has_line"))


def f5_measure_rejects(m: Mart) -> DataFrame:
    """clean staging rows whose NUMERIC(10,3) measures overflow (``try_cast`` gives NULL)."""
    from flowmart.operators.facts import g2_measures

    return QL.fact_measure_rejects(g2_measures(m.stg)).select("service", "sport", "stime", "dur", "sload", "dload")


def s7_rejected_rows(m: Mart) -> DataFrame:
    return QL.rejected_rows(m.raw).select("srcip", "sport", "dstip", "dsport", "dur", "stime", "ltime", "error_message")


def s9_quality_profile(m: Mart) -> DataFrame:
    return QL.quality_profile(m.raw)


def s11_staging_counts(m: Mart) -> DataFrame:
    """Raw, clean and rejected staging rows as (table_name, record_count), in one pass."""
    ok = QL.row_is_valid()
    one = m.raw.agg(F.count(F.lit(1)).alias("a"), F.count(F.when(ok, 1)).alias("b"), F.count(F.when(~ok, 1)).alias("c"))
    return V.as_rows(one, {"a": "source_data", "b": "valid_rows", "c": "rejected_rows"}, "table_name", "record_count")


def _sample_order() -> list:
    return [F.col(c).asc_nulls_first() for c in USED]


def s12_valid_sample(m: Mart) -> DataFrame:
    """The simple generation's sample of valid connections - 1,000 rows in a total
    order (a top-k: each task keeps its best 1,000, the driver merges 1,000 x tasks)."""
    return g1_valid_connections(m.stg).select(*USED).orderBy(*_sample_order()).limit(1000)


def s13_distinct_sample(m: Mart) -> DataFrame:
    return g1_valid_connections(m.stg).select(*USED).distinct().orderBy(*_sample_order()).limit(1000)


def s14_merge_ports(m: Mart) -> DataFrame:
    """Insert-if-absent of the ports seen in the raw staging (rule breakers included)
    into the port dimension; existing rows win, new ports get the next ids in port order."""
    existing = m["dim_port"].select("port_id", "port_number", "range_type", "default_service")
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("port_number"), "service") for c in ("sport", "dsport")])).alias("e")
    seen = distinct_rows(m.raw.select(ends).select("e.*").filter(F.col("port_number") != 0))  # port 0 is the default member
    new = seen.groupBy("port_number").agg(F.min("service").alias("service")).select(
        "port_number", port_range(F.col("port_number")).alias("range_type"), F.coalesce("service", F.lit(UNKNOWN)).alias("default_service")
    )
    return sinks.insert_if_absent(new, existing, ["port_number"], id_col="port_id")


def s17_partition_counts(m: Mart) -> DataFrame:
    """The fact is written partitioned by month; rows per partition."""
    return sinks.partition_counts(m["fact_connection"])


def s20_window_source_count(m: Mart) -> DataFrame:
    """Fact rows whose hour lies in a window strictly inside the data."""
    t0, t1 = G2.WINDOW
    return m["fact_connection"].filter(F.col("time_id").between(t0, t1)).agg(F.count(F.lit(1)).alias("source_records"))


def s21_fact_counts(m: Mart) -> DataFrame:
    parts = [m[t].agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(t).alias("table_name"), "record_count")
             for t in ("fact_connection", "g1_fact_connections")]
    return parts[0].unionByName(parts[1])


def e7_attack_flag_facts(m: Mart) -> DataFrame:
    """The two-row attack dimension (attack / normal, no category) with the clean rows that
    resolve to each member; rows without a label resolve to none."""
    rows = m.stg.select((F.col("label") == 1).alias("is_attack")).groupBy("is_attack").agg(F.count(F.lit(1)).alias("connections"))
    return D.g1_dim_attack_v2(m.spark).join(rows, "is_attack", "left").select(
        "attack_key", "category_key", "is_attack", F.coalesce("connections", F.lit(0)).alias("connections")
    )


#: The staging rows of the first of two batches; the second one has new hours, ports and members.
FIRST_BATCH = "coalesce(proto <> 'icmp', true) and coalesce(stime < 1709535600, true) and coalesce(dsport % 5 <> 3, true)"


def _two_batches(m: Mart) -> BatchedMart:
    """A mart loaded in two batches, the second one twice; kept with ``m``."""
    first = F.expr(FIRST_BATCH)
    return m.companion("two_batches", lambda root: _load_batches(m, root, [("a", first), ("b", ~first), ("b", ~first)]))


def _load_batches(m: Mart, root: str, parts: list) -> BatchedMart:
    loaded = BatchedMart(m.spark, root)
    for name, which in parts:
        loaded.append(m.raw.filter(which), name)
    return loaded


def f4_appended_fact(m: Mart) -> DataFrame:
    """the connection fact of two appended batches, one of them replayed: the rows of one build."""
    return G2.f3_fact_connection(_two_batches(m))


def f4_appended_simple_fact(m: Mart) -> DataFrame:
    """F4 for the simple generation."""
    return G2.f1_fact_connections(_two_batches(m))


def f4_appended_hourly(m: Mart) -> DataFrame:
    """The hourly rollup over the appended fact."""
    return G2.r1_hourly_traffic(_two_batches(m))


#: Ranges that leave gaps at both ends of the data and in the middle.
DECLARED = RangePartitions("stime", [("2024_jan_late", 1705276800, 1706745600), ("2024_feb", 1706745600, 1709251200), ("2024_mar_late", 1710028800, 1711929600)])


def _range_table(m: Mart) -> DataFrame:
    """Clean staging written by declared ranges of the start time, which is missing where the source
    port is a multiple of 13."""
    rows = m.stg.withColumn("stime", F.when(F.coalesce(F.col("sport") % 13 != 0, F.lit(True)), F.col("stime")))
    return DECLARED.write(rows.select(*USED), m.scratch("declared_ranges"))


def s16_declared_partitions(m: Mart) -> DataFrame:
    """Rows per declared partition and in the default one (outside all ranges, or without a time)."""
    return DECLARED.counts(_range_table(m))


def s16_range_read(m: Mart) -> DataFrame:
    """Rows and bytes per service of an interval inside one declared range: the scan opens its
    partition only."""
    rows = DECLARED.between(_range_table(m), 1707000000, 1708300000)
    return rows.groupBy(F.coalesce("service", F.lit(UNKNOWN)).alias("service_name")).agg(
        F.count(F.lit(1)).alias("connections"), F.sum(F.col("sbytes") + F.col("dbytes")).alias("total_bytes")
    )


def s16_range_read_default(m: Mart) -> DataFrame:
    """An interval that reaches beyond the declared ranges, so that the default partition is read too."""
    rows = DECLARED.between(_range_table(m), 1708300000, 1710200000)
    return rows.groupBy("proto").agg(F.count(F.lit(1)).alias("connections"), F.min("stime").alias("first_stime"), F.max("stime").alias("last_stime"))


# ---- validation ----------------------------------------------------------------------------

def _g2_dims(m: Mart) -> dict[str, DataFrame]:
    return {k: m[k] for k in ("dim_time", "dim_service", "dim_port", "dim_state", "dim_protocol", "dim_attack")}


def v3_orphan_checks(m: Mart) -> DataFrame:
    """V1-V3: orphaned foreign keys per dimension (V4 raises when any is > 0)."""
    counts = V.orphan_counts(m["fact_connection"], _g2_dims(m))
    return counts


def v5_orphan_matrix(m: Mart) -> DataFrame:
    return V.orphan_matrix(m["fact_connection"], m["dim_service"], m["dim_protocol"])


def v6_active_service_facts(m: Mart) -> DataFrame:
    """V6: facts kept / removed by the active-service rule, in one pass (the kept rows
    themselves are ``validation.facts_of_active_services``)."""
    return _active_split(m, m["dim_service"])


def _active_split(m: Mart, service: DataFrame) -> DataFrame:
    active = service.filter("is_active").select("service_id", F.lit(True).alias("_active"))
    f = m["fact_connection"].join(active, "service_id", "left")
    return f.agg(
        F.count(F.when(F.col("_active"), 1)).alias("kept_rows"),
        F.count(F.when(F.col("_active").isNull(), 1)).alias("removed_rows"),
    )


# The same checks over input that breaks them: dimensions without some members, services
# that are inactive, measures that overflow, tampered tables.

def _pruned_dims(m: Mart) -> dict[str, DataFrame]:
    """The dimensions without every fifth hour, dns, ports that are 3 modulo 7, FIN, icmp and DoS."""
    d = _g2_dims(m)
    return {
        "dim_time": d["dim_time"].filter(F.col("time_id") % 18000 != 0),
        "dim_service": d["dim_service"].filter(F.col("name") != "dns"),
        "dim_port": d["dim_port"].filter(F.col("port_number") % 7 != 3),
        "dim_state": d["dim_state"].filter(F.col("name") != "FIN"),
        "dim_protocol": d["dim_protocol"].filter(F.col("name") != "icmp"),
        "dim_attack": d["dim_attack"].filter(F.col("category") != "DoS"),
    }


def v3_orphans_found(m: Mart) -> DataFrame:
    return V.orphan_counts(m["fact_connection"], _pruned_dims(m))


def v5_orphans_found(m: Mart) -> DataFrame:
    d = _pruned_dims(m)
    return V.orphan_matrix(m["fact_connection"], d["dim_service"], d["dim_protocol"])


def v6_inactive_removed(m: Mart) -> DataFrame:
    return _active_split(m, m["dim_service"].withColumn("is_active", ~F.col("name").isin("ftp", "ssh")))


def f5_overflow_found(m: Mart) -> DataFrame:
    """F5 on measures scaled past NUMERIC(10,3): the loads times 200."""
    from flowmart.operators.facts import g2_measures

    scaled = m.stg.withColumn("sload", F.col("sload") * 200).withColumn("dload", F.col("dload") * 200)
    return QL.fact_measure_rejects(g2_measures(scaled)).select("service", "sport", "stime", "dur", "sload", "dload")


def _checked_tables(m: Mart) -> dict[str, DataFrame]:
    return {
        "fact_connection": m["fact_connection"],
        "fact_hourly_traffic": G2.hourly(m),
        "fact_daily_traffic": G2.daily_literal(m),
        "fact_monthly_traffic": G2.monthly_literal(m),
        "fact_service_stats": G2.service_stats(m),
        "fact_port_usage": G2.port_usage(m),
    }


def v8_declared_checks(m: Mart) -> DataFrame:
    """V8: rows that break a declared CHECK rule, per table."""
    return V.check_violations(_checked_tables(m))


def v8_checks_found(m: Mart) -> DataFrame:
    """The declared CHECK rules over tampered tables: bytes made negative where they end in 7, one
    connection too many on odd days, peaks moved by 20 hours, first use after the last."""
    t = _checked_tables(m)
    odd = F.expr("case when time_id div 86400 % 2 = 1 then 1 else 0 end")
    more = lambda df, c: df.withColumn(c, F.col(c) + odd)
    return V.check_violations({
        "fact_connection": t["fact_connection"].withColumn("source_bytes", F.when(F.col("source_bytes") % 10 == 7, -F.col("source_bytes")).otherwise(F.col("source_bytes"))),
        "fact_hourly_traffic": more(t["fact_hourly_traffic"], "total_connections"),
        "fact_daily_traffic": more(t["fact_daily_traffic"], "total_connections").withColumn("peak_hour", F.col("peak_hour") + 20),
        "fact_monthly_traffic": more(t["fact_monthly_traffic"], "total_connections"),
        "fact_service_stats": more(t["fact_service_stats"], "total_connections").withColumn("peak_hour_normal", F.col("peak_hour_normal") + 20),
        "fact_port_usage": more(t["fact_port_usage"], "total_usage").withColumn("first_seen", F.col("last_seen") + F.expr("make_interval(0,0,0,0,1)")),
    })


def v8_duplicates_found(m: Mart) -> DataFrame:
    """Declared keys over tables in which some rows occur twice (even hours, ports that are 1
    modulo 4, HIGH risk services, severity 4 attacks), and the facts' own keys."""
    twice = lambda df, which: df.unionByName(df.filter(which))
    keys4 = ["time_id", "service_id", "protocol_id", "attack_id"]
    even = "time_id % 7200 = 0"
    return V.key_violations({
        "dim_time": (twice(m["dim_time"], even), ["time_id"]),
        "dim_service": (twice(m["dim_service"], "risk_level = 'HIGH'"), ["name"]),
        "dim_port": (twice(m["dim_port"], "port_number % 4 = 1"), ["port_number"]),
        "dim_attack": (twice(m["dim_attack"], "severity = 4"), ["category"]),
        "fact_connection": (twice(m["fact_connection"], even), ["connection_id"]),
        "fact_hourly_traffic": (twice(G2.hourly(m), even), keys4),
        "fact_service_stats": (twice(G2.service_stats(m), even), keys4),
        "fact_port_usage": (twice(G2.port_usage(m), even), ["port_id", *keys4]),
    })


def v9_coherence(m: Mart, found: bool = False) -> DataFrame:
    """V9: keys at which the hourly, daily and monthly rollups disagree with the fact, and facts
    whose source or destination port is out of range.

    One scan of the fact gives additive counts per hour and keys; summed to hours, days and months
    they meet all three rollups in one aggregate."""
    hourly, daily, monthly = G2.hourly(m), G2.daily_literal(m), G2.monthly_literal(m)
    ports = m.dim("dim_port")
    if found:  # rollups without the udp rows of odd days, a port dimension shifted by 60,000
        udp = m["dim_protocol"].filter("name = 'udp'").agg(F.max("protocol_id")).scalar()
        gap = F.expr("time_id div 86400 % 2 = 0") | (F.col("protocol_id") != udp)
        hourly, daily, monthly = (t.filter(gap) for t in (hourly, daily, monthly))
        ports = ports.withColumn("port_number", F.col("port_number") + 60000)
    cells = V.fact_cells(m["fact_connection"], ports, MAX_PORT)
    return V.coherence(cells, hourly, daily, monthly, m["dim_time"])


def v9_incoherence_found(m: Mart) -> DataFrame:
    return v9_coherence(m, found=True)


def v8_key_violations(m: Mart) -> DataFrame:
    """V8: declared keys. The literal daily rollup breaks its unique key (one row per
    active hour of the day) - reported, as the table definition would reject it."""
    keys4 = ["time_id", "service_id", "protocol_id", "attack_id"]
    return V.key_violations({
        "dim_time": (m["dim_time"], ["time_id"]),
        "dim_service": (m["dim_service"], ["name"]),
        "dim_port": (m["dim_port"], ["port_number"]),
        "dim_attack": (m["dim_attack"], ["category"]),
        "fact_hourly_traffic": (G2.hourly(m), keys4),
        "fact_daily_traffic": (G2.daily_literal(m), keys4),
        "fact_daily_traffic_declared": (G2.daily_declared(m), keys4),
    })


def v9_business_rules(m: Mart, found: bool = False) -> DataFrame:
    """V9: written business rules as (rule, violations); the rules over facts come from one scan."""
    a, services, hourly, ports, times = m["dim_attack"], m["dim_service"], G2.hourly(m), m.dim("dim_port"), m["dim_time"]
    if found:  # missing hours, inactive services, a rollup without udp rows of odd days, shifted ports, wrong severities
        udp = m["dim_protocol"].filter("name = 'udp'").agg(F.max("protocol_id")).scalar()
        hourly = hourly.filter(F.expr("time_id div 86400 % 2 = 0") | (F.col("protocol_id") != udp))
        times = times.filter("hour % 4 <> 1").withColumn("datetime", F.when(F.col("hour") == 3, F.expr("datetime + interval 1000 years")).otherwise(F.col("datetime")))
        services = services.withColumn("is_active", ~F.col("name").isin("ftp", "ssh"))
        ports = ports.withColumn("port_number", F.col("port_number") + 60000)
        a = a.withColumn("severity", F.when(F.col("category").isin("Worms", "Fuzzers"), 0).otherwise(F.col("severity")))
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    sides = V.hourly_sides(V.fact_cells(m["fact_connection"], ports, MAX_PORT), hourly)
    inactive = services.filter(~F.col("is_active")).select("service_id", F.lit(True).alias("inactive"))
    sides = sides.join(sized(inactive, m.sizes["dim_service"]), "service_id", "left")
    rows = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0)).cast("bigint")
    expected_sev = lookup(F.col("category"), ATTACK_SEVERITY, ATTACK_SEVERITY_DEFAULT)
    rules = {
        "hour_gaps": n(V.hour_gaps(times)),
        "future_hours": n(times.filter(F.col("datetime") > F.current_timestamp())),
        "hourly_rollup_mismatch": F.count(F.when(F.col("n_fact") != F.col("n_rollup"), 1)),
        "inactive_services": rows("n_fact", F.col("inactive")),
        "ports_out_of_range": rows("bad_dest", F.lit(True)),
        "unclassified_connections": rows("n_fact", F.col("attack_id").isNull()),
        "severity_mismatch": n(a.filter(F.col("is_attack") & (F.col("severity") != expected_sev))),
    }
    from_facts = [k for k in rules if k not in ("hour_gaps", "future_hours", "severity_mismatch")]
    one = sides.agg(*[rules[k].alias(k) for k in from_facts]).select("*", *[v.alias(k) for k, v in rules.items() if k not in from_facts])
    return V.as_rows(one, {k: k for k in rules}, "rule", "violations")


def v9_rules_found(m: Mart) -> DataFrame:
    return v9_business_rules(m, found=True)


# ---- versioning, refresh, streaming ------------------------------------------------------------

SCD_AS_OF = _dt.datetime(2024, 3, 1)


def d10_scd2_service(m: Mart) -> DataFrame:
    """A new snapshot of the service dimension in which each service's protocol is
    the largest one seen (instead of the smallest) is merged as of 2024-03-01: changed
    services get a closed version 1 and an open version 2."""
    members = m["members"].filter(F.col("dim") == D.M_SERVICE).select("name")
    pairs = distinct_rows(m.stg.filter(F.col("service").isNotNull()).select(F.col("service").alias("name"), "proto"))
    latest_proto = pairs.groupBy("name").agg(F.max("proto").alias("protocol"))
    snapshot = members.join(latest_proto, "name")
    merged = scd.scd2_merge(m["dim_service"], snapshot, "name", ["protocol"], SCD_AS_OF)
    return merged.select(
        "name", "protocol", "version", "is_active",
        F.date_format("valid_from", G2.TS_FMT).alias("valid_from"), F.date_format("valid_to", G2.TS_FMT).alias("valid_to"),
    )


def _port_history(m: Mart) -> DataFrame:
    """The port dimension after a snapshot taken from raw staging in which each port's default service
    is the largest one seen; ports without a row are created with the next ids."""
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("port_number"), "service") for c in ("sport", "dsport")])).alias("e")
    seen = distinct_rows(m.raw.select(ends).select("e.*").filter(F.col("port_number") != 0))
    snapshot = seen.groupBy("port_number").agg(F.max("service").alias("s"))
    snapshot = snapshot.select("port_number", F.coalesce("s", F.lit(UNKNOWN)).alias("default_service"))
    old = m["dim_port"].filter(F.col("port_number") % 10 != 9)  # so that there are new members
    return scd.scd2_merge(old, snapshot, "port_number", ["default_service"], SCD_AS_OF, id_col="port_id")


def d10_scd2_port(m: Mart) -> DataFrame:
    """D10 for ports (``_port_history``)."""
    return _port_history(m).select(
        "port_number", "default_service", "version", "is_active",
        F.date_format("valid_from", G2.TS_FMT).alias("valid_from"), F.date_format("valid_to", G2.TS_FMT).alias("valid_to"),
        (F.count(F.lit(1)).over(Window.partitionBy("port_id")) == F.max("version").over(Window.partitionBy("port_id"))).alias("id_is_own"),
    )


def d10_ports_as_of(m: Mart) -> DataFrame:
    """The port dimension of ``d10_scd2_port`` as it was valid in February 2024."""
    merged = d10_scd2_port(m).withColumn("valid_from", F.to_timestamp("valid_from", G2.TS_FMT)).withColumn("valid_to", F.to_timestamp("valid_to", G2.TS_FMT))
    return scd.as_of(merged, _dt.datetime(2024, 2, 15)).select("port_number", "default_service", "version")


DERIVED.update({
    "mv_hourly_service_stats": Derived(lambda m, w: G1.r5_hourly_service_stats(m), ("g1_fact_connections",)),
    "mv_daily_traffic": Derived(lambda m, w: G1.r6_daily_traffic(m), ("g1_fact_connections",)),
    "mv_weekly_traffic": Derived(lambda m, w: G1.r7_weekly_traffic(m), ("g1_fact_connections",)),
})
VIEWS = ("mv_hourly_service_stats", "mv_daily_traffic", "mv_weekly_traffic", "mv_hourly_service_performance", "mv_daily_attack_patterns",
         "mv_service_risk_profile", "mv_port_security_analysis")


def r12_refresh_views(m: Mart) -> DataFrame:
    """Recompute the rollups and special facts that the views read, then write every materialised
    view anew; report rows per view.

    The seven refreshes are independent, so they are submitted as concurrent Spark jobs
    (driver threads); the scheduler interleaves their tasks on the executors."""
    G2.refresh_rollups(m)
    m.rebuild_all(["fact_service_stats", "fact_port_usage"])
    counts = m.rebuild_all(list(VIEWS))
    return V.as_rows(m.spark.range(1).select(*[F.lit(n).alias(k) for k, n in counts.items()]), {k: k for k in counts}, "view_name", "record_count")


#: The service dimension's history: when a snapshot was merged, and how its protocol follows from the
#: smallest and largest one seen (services without one are not in the snapshot).
HISTORY = [
    (_dt.datetime(2024, 2, 1), "hi"),
    (_dt.datetime(2024, 3, 10), "case when name <> 'ftp' then concat(lo, '/', hi) end"),
]


def _service_history(m: Mart) -> DataFrame:
    """Up to three versions of a service; ssh is only created by the first snapshot."""
    pairs = distinct_rows(m.stg.filter(F.col("service").isNotNull()).select(F.col("service").alias("name"), "proto"))
    seen = pairs.groupBy("name").agg(F.min("proto").alias("lo"), F.max("proto").alias("hi"))
    dim = m["dim_service"].filter("name <> 'ssh'")
    for as_of, protocol in HISTORY:
        dim = scd.scd2_merge(dim, seen.select("name", F.expr(protocol).alias("protocol")).filter("protocol is not null"), "name", ["protocol"], as_of, id_col="service_id")
    return dim


def d10_facts_as_of(m: Mart) -> DataFrame:
    """D10 + F3: every clean connection with the versions of its service and destination port that were
    valid at its own start time; nothing where the member did not exist yet."""
    rows = m.stg.filter(F.col("stime").isNotNull()).select("stime", "service", "dsport", "sbytes", "dbytes")
    services, ports = (write_table(h, m.scratch(n)) for h, n in ((_service_history(m), "service_history"), (_port_history(m), "port_history")))
    rows = resolve_as_of(rows, "stime", "service", services, "name", {"version": "service_version", "protocol": "service_protocol"})
    rows = resolve_as_of(rows, "stime", "dsport", ports, "port_number", {"version": "port_version", "default_service": "port_service"}, width=30 * 86400)
    return rows.select("stime", F.col("service").alias("service_name"), "service_version", "service_protocol", F.col("dsport").alias("dest_port"), "port_version", "port_service", "sbytes", "dbytes")


def x1_stream_hourly_rollup(m: Mart) -> DataFrame:
    """The streaming hourly rollup run to completion over the events table
    (``availableNow``); result = the sum of all batches' partials."""
    if not m.sf_dir:
        raise ValueError("the streaming rollup needs the folder of the events table")
    sink, ckpt = m.scratch("x1_sink"), m.scratch("x1_checkpoint")  # a stream starts anew
    X.start(m.spark, f"{m.sf_dir}/events.parquet", sink, ckpt).awaitTermination()
    return X.rollup(m.spark, sink)


def x1_compacted_rollup(m: Mart) -> DataFrame:
    """X1 over four files, one per micro-batch, compacted after the third and at the end: the same rollup
    from one folder."""
    if not m.sf_dir:
        raise ValueError("the streaming rollup needs the folder of the events table")
    files, sink, ckpt = m.scratch("x1_files"), m.scratch("x1_sink"), m.scratch("x1_checkpoint")
    events = read_events(m.spark, m.sf_dir).withColumn("part", F.pmod("event_id", F.lit(4)))
    for part in range(4):
        events.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(files)
        X.start(m.spark, files, sink, ckpt).awaitTermination()
        if part >= 2:
            X.compact(m.spark, sink, keep=0)
    return X.rollup(m.spark, sink)
