"""Validation operators (V1-V9): referential checks, orphan matrix, declared keys and the
written business rules, each as an aggregate that returns one small row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# (fact foreign key, dimension name, dimension key)
FACT_KEYS = [
    ("time_id", "dim_time", "time_id"),
    ("service_id", "dim_service", "service_id"),
    ("source_port_id", "dim_port", "port_id"),
    ("dest_port_id", "dim_port", "port_id"),
    ("state_id", "dim_state", "state_id"),
    ("protocol_id", "dim_protocol", "protocol_id"),
    ("attack_id", "dim_attack", "attack_id"),
]


def as_rows(one: DataFrame, names: dict[str, str], key: str, value: str) -> DataFrame:
    """The columns of a one-row aggregate as (key, value) rows."""
    pairs = [F.struct(F.lit(shown).alias(key), F.col(c).cast("bigint").alias(value)) for c, shown in names.items()]
    return one.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def orphan_counts(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """V1-V3: per foreign key, fact rows whose key is missing from the dimension. One pass over
    the fact: a left lookup per key and one aggregate with a count each."""
    rows = fact.select(*[fk for fk, _, _ in FACT_KEYS])
    for fk, dim, key in FACT_KEYS:
        keys = dims[dim].select(F.col(key).alias(fk)).distinct().withColumn(f"has_{fk}", F.lit(True))
        rows = rows.join(keys, fk, "left")
    one = rows.agg(*[F.count(F.when(F.col(f"has_{fk}").isNull(), 1)).alias(fk) for fk, _, _ in FACT_KEYS])
    return as_rows(one, {fk: fk for fk, _, _ in FACT_KEYS}, "check_name", "orphan_count")


def orphan_messages(counts: DataFrame) -> DataFrame:
    """V1/V2: one message per key with orphans."""
    return counts.filter(F.col("orphan_count") > 0).select(
        F.concat(F.col("orphan_count").cast("string"), F.lit(" fact rows have no dimension row for "), F.col("check_name")).alias("error_message")
    )


def raise_on_errors(messages: DataFrame) -> None:
    """V4: gather the (few) messages and raise them joined by newlines."""
    row = messages.agg(F.array_join(F.collect_list("error_message"), "\n").alias("errors")).first()
    if row and row["errors"]:
        raise ValueError(f"the fact breaks its references: {row['errors']}")


def orphan_matrix(fact: DataFrame, service: DataFrame, protocol: DataFrame) -> DataFrame:
    """V5: total rows and rows whose service / protocol lookup fails, in one pass."""
    s = service.select(F.col("service_id").alias("_s"))
    p = protocol.select(F.col("protocol_id").alias("_p"))
    j = fact.join(s, fact["service_id"] == s["_s"], "left").join(p, fact["protocol_id"] == p["_p"], "left")
    return j.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count(F.when(F.col("_s").isNull(), 1)).alias("orphaned_services"),
        F.count(F.when(F.col("_p").isNull(), 1)).alias("orphaned_protocols"),
    ).select(F.lit("FACT_CONNECTION").alias("table_name"), "*")


def facts_of_active_services(fact: DataFrame, service: DataFrame) -> DataFrame:
    """V6: keep facts whose service is active (``left_semi``; NOT IN would return nothing
    as soon as the subquery holds a NULL)."""
    active = service.filter("is_active").select("service_id")
    return fact.join(active, "service_id", "left_semi")


def audit_summary(audit: DataFrame) -> DataFrame:
    """V7: number of batches, MAX(status) as the reference reports it, and the status of
    the latest batch."""
    return audit.agg(
        F.count(F.lit(1)).alias("batches"),
        F.max("status").alias("max_status"),
        F.max_by("status", "batch_id").alias("latest_status"),
    )


def key_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """V8: duplicate primary / unique keys per table -> (table_name, key, violations)."""
    parts = []
    for name, (df, key) in tables.items():
        dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_one_active(dims: dict[str, tuple[DataFrame, str]]) -> None:
    """Raise unless every natural key has at most one active row: a second one would double the
    facts that look it up."""
    rows = None
    for name, (df, key) in dims.items():
        active = df.filter("is_active") if "is_active" in df.columns else df
        keys = active.select(F.lit(f"{key} in {name}").alias("what"), F.col(key).cast("string").alias("key"))
        rows = keys if rows is None else rows.unionByName(keys)
    twice = rows.groupBy("what", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bad = twice.groupBy("what").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per dimension at most
    if bad:
        raise ValueError("several active rows for one natural key: " + ", ".join(f"{r.n} of {r.what}" for r in sorted(bad)))


# Declared CHECK rules: (table, rule, predicate that every row must satisfy; NULL passes).
CHECKS = [
    ("fact_connection", "non_negative_measures", "duration >= 0 and source_bytes >= 0 and dest_bytes >= 0 and source_packets >= 0 and dest_packets >= 0"),
    ("fact_hourly_traffic", "total_is_normal_plus_attack", "total_connections = normal_connections + attack_connections"),
    ("fact_daily_traffic", "total_is_normal_plus_attack", "total_connections = normal_connections + attack_connections"),
    ("fact_daily_traffic", "peak_hour_of_day", "peak_hour between 0 and 23"),
    ("fact_monthly_traffic", "total_is_normal_plus_attack", "total_connections = normal_connections + attack_connections"),
    ("fact_service_stats", "total_is_normal_plus_attack", "total_connections = normal_connections + attack_connections"),
    ("fact_service_stats", "peak_hour_of_day", "peak_hour_normal between 0 and 23 and peak_hour_attack between 0 and 23"),
    ("fact_port_usage", "total_is_normal_plus_attack", "total_usage = normal_usage + attack_usage"),
    ("fact_port_usage", "first_seen_before_last", "first_seen <= last_seen"),
]


def check_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """V8: rows that break a declared CHECK, per table and rule; one pass per table."""
    parts = []
    for name, df in tables.items():
        rules = {rule: predicate for table, rule, predicate in CHECKS if table == name}
        one = df.agg(*[F.count(F.when(F.expr(f"not ({x})"), 1)).alias(rule) for rule, x in rules.items()])
        parts.append(as_rows(one, {rule: rule for rule in rules}, "rule", "violations").select(F.lit(name).alias("table_name"), "rule", "violations"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


KEYS = ["service_id", "protocol_id", "attack_id"]


def fact_cells(fact: DataFrame, ports: DataFrame, max_port: int) -> DataFrame:
    """Additive counts of the fact per (hour, service, protocol, attack), from one scan: its rows, and those
    whose source or destination port number is out of range."""
    numbers = lambda key, name: ports.select(F.col("port_id").alias(key), F.col("port_number").alias(name))
    f = fact.select("time_id", "service_id", "protocol_id", "attack_id", "source_port_id", "dest_port_id")
    f = f.join(numbers("source_port_id", "_sp"), "source_port_id", "left").join(numbers("dest_port_id", "_dp"), "dest_port_id", "left")
    out = lambda c: F.count(F.when(~F.col(c).between(0, max_port), 1))
    return f.groupBy("time_id", "service_id", "protocol_id", "attack_id").agg(F.count(F.lit(1)).alias("n"), out("_sp").alias("bad_source"), out("_dp").alias("bad_dest"))


def coherence(cells: DataFrame, hourly: DataFrame, daily: DataFrame, monthly: DataFrame, dim_time: DataFrame) -> DataFrame:
    """V9: (rule, violations): keys at which a rollup and the fact's counts disagree (either side may lack
    the key), and rows out of range, all from ``fact_cells``.

    Each cell counts for its hour, for its hour of its day and for its day of its month; rollup
    rows stand beside them with their own totals, and one aggregate over all three levels sets
    the two sides against each other."""
    keys = KEYS
    t = F.col("time_id")
    ts = F.timestamp_seconds(t)
    day, month = (t - F.pmod(t, F.lit(86400))), F.unix_seconds(F.date_trunc("month", ts))
    # First hours of days and months: a row per hour of the calendar.
    firsts = dim_time.select("time_id", F.min("time_id").over(Window.partitionBy(day)).alias("first_of_day"), F.min("time_id").over(Window.partitionBy(month)).alias("first_of_month"))
    zero = F.lit(0).cast("bigint")
    none = F.lit(-1)
    levels = F.explode(F.array(
        F.struct(F.lit("hourly").alias("level"), t.alias("at"), none.alias("sub")),
        F.struct(F.lit("daily").alias("level"), F.col("first_of_day").alias("at"), F.hour(ts).alias("sub")),
        F.struct(F.lit("monthly").alias("level"), F.col("first_of_month").alias("at"), F.dayofmonth(ts).alias("sub")),
    )).alias("x")
    counted = cells.join(firsts, "time_id", "left").select(*keys, "n", "bad_source", "bad_dest", levels).select("x.*", *keys, F.col("n").alias("n_fact"), zero.alias("n_rollup"), "bad_source", "bad_dest")
    for level, table, sub in (("hourly", hourly, none), ("daily", daily, F.col("peak_hour")), ("monthly", monthly, F.col("peak_day"))):
        counted = counted.unionByName(table.select(
            F.lit(level).alias("level"), t.alias("at"), sub.cast("int").alias("sub"), *keys, zero.alias("n_fact"), F.col("total_connections").alias("n_rollup"), zero.alias("bad_source"), zero.alias("bad_dest"),
        ))
    sides = counted.groupBy("level", "at", "sub", *keys).agg(*[F.sum(c).alias(c) for c in ("n_fact", "n_rollup", "bad_source", "bad_dest")])
    off = lambda level: F.count(F.when((F.col("level") == level) & (F.col("n_fact") != F.col("n_rollup")), 1))
    rows = lambda c: F.coalesce(F.sum(F.when(F.col("level") == "hourly", F.col(c))), zero)
    rules = {
        "hourly_rollup_mismatch": off("hourly"), "daily_rollup_mismatch": off("daily"), "monthly_rollup_mismatch": off("monthly"),
        "source_ports_out_of_range": rows("bad_source"), "dest_ports_out_of_range": rows("bad_dest"),
    }
    return as_rows(sides.agg(*[v.alias(k) for k, v in rules.items()]), {k: k for k in rules}, "rule", "violations")


def hourly_sides(cells: DataFrame, hourly: DataFrame) -> DataFrame:
    """(hour and keys, n_fact, n_rollup, bad_dest): the fact's counts and the hourly rollup's beside each other."""
    zero = F.lit(0).cast("bigint")
    both = cells.select("time_id", *KEYS, F.col("n").alias("n_fact"), zero.alias("n_rollup"), "bad_dest").unionByName(
        hourly.select("time_id", *KEYS, zero.alias("n_fact"), F.col("total_connections").alias("n_rollup"), zero.alias("bad_dest"))
    )
    return both.groupBy("time_id", *KEYS).agg(*[F.sum(c).alias(c) for c in ("n_fact", "n_rollup", "bad_dest")])


def hour_gaps(dim_time: DataFrame) -> DataFrame:
    """V9 (no gaps): consecutive hours of the time dimension more than one hour apart.
    The window orders one row per hour of the range (bounded by the range, not the data)."""
    w = Window.orderBy("time_id")
    return dim_time.select("time_id", (F.lead("time_id").over(w) - F.col("time_id")).alias("step")).filter(F.col("step") > 3600)
